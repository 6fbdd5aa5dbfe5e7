"""Quality rules, line first: lines that fail a rule are removed, then documents that lost too much.

Words are runs of anything but the six ASCII white-space characters; lines are split at ``\\n`` and
those without a word play no part. Each document is judged on its own, so the work is a scan: Arrow
batches go through a Python function that reads whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.llm.common import free_name, query, table

SYMBOLS = b"#*$%&|<>"
MENU_MARKS = "|>•·»"
SENTENCE_ENDS = ".!?:;\"'”’»)…。！？"
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "uses cookies",
    "enable javascript",
    "javascript is disabled",
    "privacy policy",
    "terms of service",
    "terms of use",
    "subscribe to our newsletter",
    "sign up for our newsletter",
    "click here to",
    "skip to content",
    "lorem ipsum",
)
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))
_UPPER = re.compile(rb"[^A-Z]+")
_LOWER = re.compile(rb"[^a-z]+")

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50
#: Boilerplate phrases count in lines of at most so many words.
BOILERPLATE_WORDS = 40

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words",
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that is found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    numbers = {}
    ids = np.fromiter(map(numbers.setdefault, words, count()), np.int64, n)
    # Pairs are numbered before the third word joins, so that the key stays below 2^63.
    pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
    _, inverse, found = np.unique(
        pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True
    )
    again = found[inverse] > 1
    covered = np.zeros(n, bool)
    covered[:-2] |= again
    covered[1:-1] |= again
    covered[2:] |= again
    return int(covered.sum())


def line_fails(line: str, words: int) -> bool:
    """Punctuation, menu, symbol, shouting and boilerplate rules on one line with words."""
    if line.rstrip(" \t\n\r\x0b\x0c")[-1] not in SENTENCE_ENDS:
        return True
    if 3 * sum(map(line.count, MENU_MARKS)) >= words:
        return True
    raw = line.encode("utf-8", "surrogatepass")
    if 4 * (len(raw) - len(raw.translate(None, SYMBOLS))) >= words:
        return True
    upper = len(_UPPER.sub(b"", raw))
    if upper >= 10 and upper > len(_LOWER.sub(b"", raw)):
        return True
    return words <= BOILERPLATE_WORDS and _BOILERPLATE.search(line.lower()) is not None


def judge(text: str | None) -> tuple[int, int, int, int, int, int, str]:
    """The values of :data:`COUNTS` and the text without failing lines, for one text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, b" \t\n\r\x0b\x0c"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: Counter[str] = Counter()
    lost = 0
    good = []
    for line in text.split("\n"):
        n = len(line.encode("utf-8", "surrogatepass").split())
        if not n:
            good.append(line)
            continue
        seen[line] += 1
        if seen[line] > 1 or line_fails(line, n):
            lost += n
        else:
            good.append(line)
    duplicates = sum(seen.values()) - len(seen)
    clean = "\n".join(good)
    return (
        len(words), len(text) - spaces, symbols, duplicates, repeated_words(words), lost, clean,
    )


def _judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([judge(t) for t in texts], columns=[*COUNTS, "clean_text"])


def _counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([judge(t)[:-1] for t in texts], columns=list(COUNTS))


def line_first(
    docs: DataFrame, text_col: str = "text", name: str = "quality", with_text: bool = True
) -> DataFrame:
    """``docs`` with the struct ``name``: the counts, ``base_failed``, ``kept`` and ``clean_text``.

    A document fails the base rules with fewer than :data:`MIN_WORDS` words or when over
    :data:`MAX_REPEAT_PERCENT` percent of its words are in repeated 3-word windows. It is rejected if
    it fails those or its failing lines hold over :data:`MAX_LOST_PERCENT` percent of its words. Null
    text counts as empty, which fails. Rows are judged one by one: repeated rows agree, other columns
    pass unchanged, empty tables stay empty. Without ``with_text`` there is no ``clean_text``.
    """
    schema = ", ".join(f"{c} bigint" for c in COUNTS) + (", clean_text string" if with_text else "")
    # Not deterministic for the planner only, so that a filter on the result does not run it twice.
    judged = F.pandas_udf(_judged if with_text else _counted, schema).asNondeterministic()
    scored = docs.withColumn(name, judged(F.col(text_col)))
    of = F.col(name)
    base_failed = (of["n_words"] < MIN_WORDS) | (
        100 * of["n_repeat_words"] > MAX_REPEAT_PERCENT * of["n_words"]
    )
    lost = 100 * of["n_lost_words"] > MAX_LOST_PERCENT * of["n_words"]
    return scored.withColumn(
        name, of.withField("base_failed", base_failed).withField("kept", ~base_failed & ~lost)
    )


def clean(docs: DataFrame) -> DataFrame:
    """The documents kept, with their failing lines removed; same columns as ``docs``."""
    name = free_name(docs, "_quality")
    judged = line_first(docs, name=name).filter(F.col(name)["kept"])
    text = F.col(name)["clean_text"]
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length(text).cast(docs.schema["n_chars"].dataType)
    return judged.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])


_PHRASES = "|".join(BOILERPLATE)
_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
base AS (
  SELECT doc_id, text, ws, len(ws) AS n_words,
         CAST(coalesce(list_sum([length(x) for x in ws]), 0) AS BIGINT) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols
  FROM w),
wins AS (
  SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
again AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM wins)
  WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d)),
ruled AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) > 1 AS dup,
    NOT regexp_matches(line, '[.!?:;"''”’»)…。！？][\x20\x09-\x0D]*$')
    OR 3 * length(regexp_replace(line, '[^|>•·»]', '', 'g')) >= n
    OR 4 * length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) >= n
    OR (length(regexp_replace(line, '[^A-Z]', '', 'g')) >= 10
        AND length(regexp_replace(line, '[^A-Z]', '', 'g'))
            > length(regexp_replace(line, '[^a-z]', '', 'g')))
    OR (n <= {BOILERPLATE_WORDS} AND regexp_matches(lower(line), '{_PHRASES}')) AS fails
  FROM lines WHERE n > 0),
losses AS (
  SELECT doc_id, count(*) FILTER (WHERE dup) AS n_dup_lines,
         CAST(coalesce(sum(n) FILTER (WHERE dup OR fails), 0) AS BIGINT) AS lost
  FROM ruled GROUP BY doc_id),
joined AS (
  SELECT b.doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words, coalesce(lost, 0) AS n_lost_words
  FROM base b LEFT JOIN covered c USING (doc_id) LEFT JOIN losses USING (doc_id))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
       AND NOT 100 * n_lost_words > {MAX_LOST_PERCENT} * n_words AS kept
FROM joined"""


@query(_SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = line_first(docs, with_text=False)
    return judged.select("doc_id", *[f"quality.{c}" for c in (*COUNTS, "base_failed", "kept")])
