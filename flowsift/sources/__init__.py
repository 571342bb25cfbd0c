"""Packet, capture, rule-file and labelled-flow sources."""
