"""TCP flag letter counting (P6) and the terminator predicate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowsift.config import FLAG_LETTERS


def letter_count(flags: Column, letter: str) -> Column:
    """Occurrences of one flag letter in a TCP flag-letter string ("SA", "FPU"); null counts 0."""
    f = F.coalesce(flags, F.lit(""))
    return (F.length(f) - F.length(F.replace(f, F.lit(letter), F.lit("")))).cast("long")


def flag_count_columns(flags: Column) -> list[Column]:
    """One count column per tracked letter, named after its feature."""
    return [letter_count(flags, letter).alias(name) for letter, name in FLAG_LETTERS]


def is_terminator(flags: Column) -> Column:
    """A packet carrying FIN or RST closes its flow (the packet is included)."""
    f = F.coalesce(flags, F.lit(""))
    return (F.instr(f, "F") > 0) | (F.instr(f, "R") > 0)
