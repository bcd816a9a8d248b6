"""From raw rows to written chat splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from turnmill import config
from turnmill.operators import cleaning, sampling
from turnmill.scratch import drop, stage
from turnmill.sources.rows import write_splits


def curated(raw: DataFrame, params: config.CurateParams | None = None) -> DataFrame:
    """Clean rows that survive dedup and the quality rules, lazily: one shuffle.

    Dedup comes first: the row it keeps may then fail the quality rules, and its whole
    key is gone. A row that fails still takes part, but with its key and order alone,
    so that texts are shuffled only where they can survive.
    """
    p = params or config.CurateParams()
    cleaned = cleaning.clean_rows(cleaning.drop_blank(raw), p)
    judged = cleaned.withColumns({
        "_passes": cleaning.reject_reason(p).isNull(),
        "_text": F.col("instruction"),
    })
    payload = [c for c in raw.columns if c != "row_id"]
    lightened = judged.withColumns({c: F.when(F.col("_passes"), F.col(c)) for c in payload})
    kept = sampling.dedup(lightened, p.seed, "_text").where("_passes")
    return kept.select(*raw.columns)


def split_rows(raw: DataFrame, params: config.CurateParams | None = None) -> DataFrame:
    """Curated rows with ``split`` and ``split_order``.

    The curated rows are written once to the shared folder; the split lookups and all
    sinks read that table.
    """
    return sampling.split_exact(stage(curated(raw, params), "curated"), params)


def curate(raw: DataFrame, chat_path: str, raw_path: str,
           params: config.CurateParams | None = None, mode: str = "errorifexists") -> None:
    """Write chat splits and, for evaluation, the same rows with their own columns."""
    p = params or config.CurateParams()
    rows = split_rows(raw, p)
    chat = cleaning.to_chat(rows, keep=("split", "split_order", "row_id"), system=p.system_prompt)
    write_splits(chat, chat_path, mode)
    write_splits(rows, raw_path, mode)
    drop(rows)
