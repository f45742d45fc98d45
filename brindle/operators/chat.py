"""Conversations stored as one row per turn."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brindle.operators.joins import attach
from brindle.session import settle


def last_user_query(turns: DataFrame, conv: str, turn: str, text: str, role: str | None = None) -> DataFrame:
    """Text of the newest turn per conversation, or of the newest turn by ``role``."""
    if role is not None:
        turns = turns.filter(F.col("role") == role)
    return turns.groupBy(conv).agg(F.max_by(text, turn).alias("question"))


def chat_history(turns: DataFrame, conv: str, turn: str) -> DataFrame:
    """Every turn before the newest one of its conversation."""
    newest = settle(turns.groupBy(conv).agg(F.max(turn).alias("__newest")), "newest-turn")
    return attach(turns, newest, [conv], "inner").filter(F.col(turn) < F.col("__newest")).drop("__newest")
