"""Language ID by cross-parsing: phrases of a text that a suffix automaton of each language needs.

A text is read word by word (a word with the space after it). A word is cut greedily into the
longest phrases that occur in a language's labelled text; what no phrase covers counts as
one phrase a character. Phrases end at words' ends, so a word's counts don't depend on
its neighbours and each worker finds them once per distinct word. The language whose
phrases, weighted by the bits to name one of its places, need the fewest bits wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.llm.base import batch, small_batches

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_UNIT = regex.compile(r"\S+")


class SuffixAutomaton:
    """All substrings of a text, in at most twice as many states as it has characters."""

    def __init__(self, text: str) -> None:
        self.next: list[dict[str, int]] = [{}]
        link, size = [-1], [0]
        last = 0
        for c in text:
            state = len(self.next)
            self.next.append({})
            size.append(size[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = state
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if size[q] == size[p] + 1:
                    link[state] = q
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[q]))
                    size.append(size[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = copy
                        p = link[p]
                    link[q] = link[state] = copy
            last = state

    def phrases(self, text: str) -> int:
        """How many longest-match phrases a left-to-right parse of the text has."""
        step, state, n = self.next, 0, 0
        for c in text:
            to = step[state].get(c)
            if to is not None:
                state = to
                continue
            if state:
                n += 1
                to = step[0].get(c)
            if to is None:
                n += 1
                state = 0
            else:
                state = to
        return n + (state > 0)


class CrossParser:
    def __init__(self, samples: dict[str, str], memo: int) -> None:
        self.langs = sorted(samples)
        self.parts = [SuffixAutomaton(samples[x]) for x in self.langs]
        self.bits = [math.log2(len(samples[x]) + 1) for x in self.langs]
        self.memo: dict[str, tuple[int, ...]] = {}
        self.size = memo

    def counts(self, word: str) -> tuple[int, ...]:
        got = self.memo.get(word)
        if got is None:
            got = tuple(a.phrases(word + " ") for a in self.parts)
            if len(self.memo) >= self.size:
                self.memo.clear()
            if len(word) <= 100:
                self.memo[word] = got
        return got

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and a score in 0..1: how far it is ahead of the second."""
        if not text or not self.langs or not _LETTER.search(text):
            return UNKNOWN, 0.0
        sums = [sum(c) for c in zip(*map(self.counts, _UNIT.findall(text.lower())), strict=True)]
        cost = [s * b for s, b in zip(sums, self.bits, strict=True)]
        order = sorted(range(len(cost)), key=lambda i: (cost[i], self.langs[i]))
        best = cost[order[0]]
        score = 1.0 if len(order) == 1 else 1 - best / cost[order[1]] if cost[order[1]] else 0.0
        return self.langs[order[0]], max(0.0, min(1.0, score))


#: One parser per worker process and model.
_PARSERS: dict[str, CrossParser] = {}


def learn(labelled: DataFrame, text_col: str, lang_col: str, key_col: str, chars: int = 120_000) -> dict[str, str]:
    """A sample of at most `chars` characters of labelled text per language.

    Rows are taken in the order of a hash of `key_col`, so every row has the same chance: first from a share of
    them that holds about twice the bound and 30 rows, and, while that does not fill a language's
    bound, from a share four times as large, up to all its rows. So a language fills its sample or gives
    all its text. Rows with a null language or text are left out; those with a null key share one hash.
    """
    rows = labelled.select(
        F.col(lang_col).cast("string").alias("lang"), F.lower(F.col(text_col)).alias("text"), F.xxhash64(F.col(key_col)).alias("place")
    ).filter("lang is not null and text is not null")
    # blanks are folded before the cut, so that they take nothing of the bound; one more character tells a word's end
    rows = rows.withColumn("text", F.substring(F.btrim(F.regexp_replace("text", r"(?U)\s+", " ")), 1, chars + 1))
    used = F.sum(F.least(F.length("text"), F.lit(chars)))
    totals = rows.groupBy("lang").agg(used.alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    shares = {r["lang"]: min(1.0, max(2 * chars / max(1, r["n"]), 30 / r["rows"])) for r in totals}
    unit = F.pmod("place", F.lit(1 << 40)) / float(1 << 40)
    samples: dict[str, str] = {}
    while shares:
        share = F.lit(0.0)
        for lang, x in shares.items():
            share = F.when(F.col("lang") == lang, F.lit(x)).otherwise(share)
        picked = rows.filter(unit < share).orderBy("lang", "place")
        out: dict[str, list[str]] = {}
        held: dict[str, int] = {}
        for r in picked.toLocalIterator():
            left = chars - held.get(r["lang"], 0)
            if left > 0:
                words = " ".join(r["text"].split())[:left] + " "
                out.setdefault(r["lang"], []).append(words)
                held[r["lang"]] = held.get(r["lang"], 0) + len(words)
        done = [lang for lang, x in shares.items() if x >= 1 or held.get(lang, 0) >= chars]
        samples.update({lang: "".join(out[lang]) for lang in done if lang in out})
        shares = {lang: min(1.0, 4 * x) for lang, x in shares.items() if lang not in done}
    return samples


def predict(docs: DataFrame, samples: dict[str, str], id_col: str = "doc_id", text_col: str = "text", memo: int = 300_000) -> DataFrame:
    """(id, lang_pred, score) of every row of `docs`; whole texts are read.

    A null text, one without a letter, or a model without languages gives `und` with score 0;
    equal costs go to the language first in order. Repeated rows each give a row; other columns
    are not touched. The samples have a fixed bound, so they are sent to the tasks whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(samples)
    name = str(hash(tuple(sorted(samples.items()))))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _PARSERS:
            _PARSERS.clear()
            _PARSERS[name] = CrossParser(sent.value, memo)
        parser = _PARSERS[name]
        for b in batches:
            got = [parser.predict(t.as_py()) for t in b.column(1)]
            yield batch(
                ["id", "lang_pred", "score"], [b.column(0), [x for x, _ in got], [s for _, s in got]], [None, pa.string(), pa.float64()]
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, lang_pred string, score double"
    )
