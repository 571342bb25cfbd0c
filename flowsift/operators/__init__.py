"""DataFrame operators: sessionizer, rules, scans, anomaly model, metrics, alerts."""
