"""Preference formatting: chosen and rejected conversations to one prompt and two masked completions.

The turns that both conversations share at their start are rendered once as the prompt; what follows on either side
is its completion. A completion's mask lists the spans of characters that are trained on: the texts of the trained
role's turns with their ends. Headers and other roles' turns are masked out. Token masks follow from the spans and a
tokenizer's offsets.

A pair's turns meet in one row by one shuffle, as its output is one row: a pair must fit into a task's memory, as it must fit
into a row. Pairs share nothing, so a turn that many of them begin with is no hot key.

Defined results: turns without a pair or a side are ignored; turns are ordered by number (null first), role and text, repeated
turns stay; a null role or text counts as empty; very long turns are rendered whole; where a side of a pair has several
conversations, they are taken by conv_id (null first) and the first is paired with the other side's first, the second with its
second and so on, a row each; a side without a conversation left is null with an empty completion, and its row has no shared
turns; two equal conversations are all prompt; an empty table gives an empty result; other columns, whatever their names, are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

TRAINED = "assistant"


def render(turn: dict) -> str:
    return f"<|{turn['role'] or ''}|>\n{turn['text'] or ''}\n"


def shared(a: list[dict], b: list[dict]) -> int:
    """Number of turns that a and b share at their start."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if (x["role"] or "", x["text"] or "") != (y["role"] or "", y["text"] or ""):
            break
        n += 1
    return n


def conversations(turns: list[dict]) -> Iterator[tuple[int | None, list[dict]]]:
    """Each conv_id of the turns (in its order) with its own."""
    for conv_id, own in groupby(turns, lambda t: t["conv_id"]):
        yield conv_id, list(own)


def complete(turns: list[dict], trained: str = TRAINED) -> tuple[str, list[tuple[int, int]]]:
    """The turns rendered, and the spans [start, end) of characters that are trained on."""
    parts, spans, at = [], [], 0
    for turn in turns:
        text = render(turn)
        if turn["role"] == trained:
            spans.append((at + len(text) - len(turn["text"] or "") - 1, at + len(text)))
        parts.append(text)
        at += len(text)
    return "".join(parts), spans


_SPANS = "array<struct<start: long, end: long>>"
SCHEMA = (
    "pair_id long, chosen_id long, rejected_id long, n_shared int, prompt string, "
    f"chosen string, chosen_mask {_SPANS}, rejected string, rejected_mask {_SPANS}"
)


def format_preferences(turns: DataFrame, trained: str = TRAINED) -> DataFrame:
    """turns (pair_id, chosen boolean, conv_id, turn, role, text) to one row of SCHEMA a pair of conversations."""
    entry = F.struct(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    side = lambda yes: F.sort_array(F.collect_list(F.when(F.col("chosen") == yes, entry)))
    pairs = (
        turns.where("pair_id IS NOT NULL AND chosen IS NOT NULL")
        .groupBy(F.col("pair_id").cast("long").alias("pair_id"))
        .agg(
            side(True).alias("a"),
            side(False).alias("b"),
        )
    )

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            out: list[tuple] = []
            for pair, left, right in zip(*(batch.column(c).to_pylist() for c in ("pair_id", "a", "b")), strict=True):
                for (first, a), (second, b) in zip_longest(conversations(left), conversations(right), fillvalue=(None, [])):
                    n = shared(a, b)
                    (chosen, mask_a), (rejected, mask_b) = complete(a[n:], trained), complete(b[n:], trained)
                    spans = [[{"start": s, "end": e} for s, e in m] for m in (mask_a, mask_b)]
                    out.append((pair, first, second, n, "".join(map(render, a[:n])), chosen, spans[0], rejected, spans[1]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), span, pa.string(), span]
            names = ["pair_id", "chosen_id", "rejected_id", "n_shared", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

    return pairs.mapInArrow(form, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, 2k as the chosen and 2k + 1 as the rejected one of pair k; masks as text start-end,..."""
    talks = table(spark, sf_dir, "conversations").withColumns(
        {"pair_id": F.floor(F.col("conv_id") / 2), "chosen": F.pmod("conv_id", F.lit(2)) == 0}
    )
    printed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return format_preferences(talks).withColumns({c: printed(c) for c in ("chosen_mask", "rejected_mask")})


ORACLE = """WITH t AS (SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side, conv_id, turn, role, text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM conversations),
a AS (SELECT * FROM t WHERE side = 0), b AS (SELECT * FROM t WHERE side = 1),
j AS (SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.k, b.k) AS k,
  coalesce(a.role = b.role AND a.text = b.text, false) AS same FROM a FULL JOIN b ON a.pair_id = b.pair_id AND a.k = b.k),
p AS (SELECT pair_id, (coalesce(min(CASE WHEN NOT same THEN k END), max(k) + 1) - 1)::INTEGER AS n_shared FROM j GROUP BY pair_id),
r AS (SELECT t.*, n_shared, '<|' || role || '|>' || chr(10) || text || chr(10) AS shown FROM t JOIN p ON t.pair_id = p.pair_id),
s AS (SELECT *, sum(length(shown)) OVER (PARTITION BY conv_id, k > n_shared ORDER BY k) AS stop FROM r)
SELECT pair_id, min(CASE WHEN side = 0 THEN conv_id END) AS chosen_id, min(CASE WHEN side = 1 THEN conv_id END) AS rejected_id,
  max(n_shared) AS n_shared,
  coalesce(string_agg(shown, '' ORDER BY k) FILTER (WHERE side = 0 AND k <= n_shared), '') AS prompt,
  coalesce(string_agg(shown, '' ORDER BY k) FILTER (WHERE side = 0 AND k > n_shared), '') AS chosen,
  coalesce(string_agg((stop - length(text) - 1)::BIGINT || '-' || stop::BIGINT, ',' ORDER BY k) FILTER (WHERE side = 0 AND k > n_shared AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(shown, '' ORDER BY k) FILTER (WHERE side = 1 AND k > n_shared), '') AS rejected,
  coalesce(string_agg((stop - length(text) - 1)::BIGINT || '-' || stop::BIGINT, ',' ORDER BY k) FILTER (WHERE side = 1 AND k > n_shared AND role = 'assistant'), '') AS rejected_mask
FROM s GROUP BY pair_id"""
