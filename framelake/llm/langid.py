"""Language identification as mixture inference.

A document is a mixture of languages: each word was drawn from one of them, with the likelihood that language's
letter trigrams give it. Expectation-maximisation estimates the proportions, and the set of languages grows only while
the likelihood gained exceeds a penalty in log(words). Models are trigram counts over all labelled rows: each task adds
its rows into one table of buckets a language, so what is shuffled and sent to the driver is bounded by languages x
buckets, whatever the number of rows."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import unused

BITS = 16
#: Languages a model may hold; a labelled table with more distinct values is refused, so what the driver gets is bounded.
MAX_LANGUAGES = 200
_CHUNK = 1 << 19

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _letters


def _grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of the trigram around each letter (anything else counts as one boundary sign), and where words begin among the letters."""
    code = np.frombuffer(("\n" + text.lower() + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[code]
    code = np.where(letter, code, 0).astype(np.uint32)
    at = np.flatnonzero(letter)
    h = code[at - 1] * np.uint32(0x9E3779B1) ^ code[at] * np.uint32(0x85EBCA77) ^ code[at + 1] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(32 - BITS)).astype(np.int64), np.flatnonzero(~letter[at - 1])


def _chunks(texts) -> Iterator[list[str]]:
    """The texts in runs of about _CHUNK characters; a longer text is a run of its own."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= _CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray  # (buckets, languages), float32

    def word_scores(self, text: str) -> np.ndarray:
        """(words, languages): each word's log-likelihood."""
        grams, begin = _grams(text)
        return np.add.reduceat(self.logp[grams], begin, axis=0) if len(grams) else np.empty((0, len(self.languages)), np.float32)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Trigram models from every row with a text and a label. An empty table gives a model without languages, by which every text is und."""
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[str, np.ndarray] = {}
        for b in batches:
            for name, group in b.groupby("lang"):
                table = tables.setdefault(name, np.zeros(1 << BITS, np.int64))
                for some in _chunks(group["text"]):
                    table += np.bincount(_grams("\n".join(some))[0], minlength=1 << BITS)
            if len(tables) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for name, table in tables.items():
            at = np.flatnonzero(table)
            yield pd.DataFrame({"lang": name, "bucket": at, "n": table[at]})

    sums = rows.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = sums.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).toPandas()
    if len(got) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.full((1 << BITS, len(got)), 0.5)
    for k, (b, n) in enumerate(zip(got["b"], got["n"], strict=True)):
        counts[np.asarray(b), k] += np.asarray(n)
    return Model(list(got["lang"]), np.log(counts / counts.sum(axis=0)).astype(np.float32)) if len(got) else Model([], np.empty((1 << BITS, 0), np.float32))


def mixtures(scores: np.ndarray, begin: np.ndarray, rounds: int = 12, penalty: float = 3.0) -> np.ndarray:
    """(documents, languages): the proportions by which each document's words, rows of scores from begin[i] on, are mixed.

    Starts from the best single language. The next candidate is the language that explains best what the set doesn't:
    the greatest sum of gains over the set's best. EM re-estimates the proportions, and the language stays if the
    log-likelihood gained exceeds penalty x log(words + 1); the first that doesn't stay ends the document's search."""
    docs, langs = len(begin), scores.shape[1]
    size = np.diff(begin, append=len(scores))
    single = np.add.reduceat(scores, begin, axis=0).astype(np.float64)
    chosen = np.zeros((docs, langs), bool)
    chosen[np.arange(docs), single.argmax(axis=1)] = True
    best = single.max(axis=1)
    share = chosen.astype(np.float64)
    open_, x, start, n = np.arange(docs), scores.astype(np.float32), begin, size
    for _ in range(langs - 1):
        owner = np.repeat(np.arange(len(open_)), n)
        held = np.where(chosen[open_][owner], x, -np.inf).max(axis=1)
        gain = np.add.reduceat(np.maximum(x - held[:, None], 0), start, axis=0)
        gain[chosen[open_]] = -1
        bound = penalty * np.log(n + 1.0)
        hope = gain.max(axis=1) > bound  # the gain of a mixture can't exceed this sum
        if not hope.any():
            break
        rows = hope[owner]
        open_, x, n = open_[hope], x[rows], n[hope]
        start = np.concatenate([[0], np.cumsum(n)[:-1]])
        owner = np.repeat(np.arange(len(open_)), n)
        trial = chosen[open_].copy()
        trial[np.arange(len(open_)), gain[hope].argmax(axis=1)] = True
        top = np.where(trial[owner], x, -np.inf).max(axis=1)
        odds = np.where(trial[owner], np.exp(x - top[:, None]), 0).astype(np.float32)
        p = trial / trial.sum(axis=1, keepdims=True)
        for _ in range(rounds):
            weighted = odds * p.astype(np.float32)[owner]
            total = weighted.sum(axis=1)
            p = np.add.reduceat(weighted / total[:, None], start, axis=0) / n[:, None]
        total = (odds * p.astype(np.float32)[owner]).sum(axis=1)
        found = np.add.reduceat(np.log(np.maximum(total, 1e-30)) + top, start).astype(np.float64)
        stays = found - best[open_] > bound[hope]
        if not stays.any():
            break
        take = open_[stays]
        chosen[take], share[take], best[take] = trial[stays], p[stays], found[stays]
        keep = stays[owner]
        open_, x, n = take, x[keep], n[stays]
        start = np.concatenate([[0], np.cumsum(n)[:-1]])
    return share


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred, score and languages (array of struct(lang, share), largest first).

    lang_pred is the language with the largest share, score that share. A null
    text, one without a letter, or a model without languages gives und, 0.0 and an empty array. Clashing columns are replaced."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def infer(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for series in texts:
            out = []
            for some in _chunks([t or "" for t in series]):
                scores = [m.word_scores(t) for t in some]
                full = [k for k, s in enumerate(scores) if s.size]
                rows: list[tuple] = [("und", 0.0, [])] * len(some)
                if full:
                    begin = np.cumsum([0] + [len(scores[k]) for k in full])[:-1]
                    for k, share in zip(full, mixtures(np.concatenate([scores[k] for k in full]), begin), strict=True):
                        order = [j for j in np.argsort(-share, kind="stable") if share[j] > 0]
                        first = order[0]
                        rows[k] = (m.languages[first], min(1.0, float(share[first])), [{"lang": m.languages[j], "share": float(share[j])} for j in order])
                out += rows
            yield pd.DataFrame(out, columns=["lang_pred", "score", "languages"])

    # Marked so that a filter on its fields is not pushed below it, which would infer twice.
    infer_udf = F.pandas_udf(infer, "lang_pred string, score double, languages array<struct<lang:string,share:double>>").asNondeterministic()
    found = unused("found", docs.columns)
    out = docs.withColumn(found, infer_udf(F.col(text)))
    return out.withColumns({k: F.col(f"{found}.{k}") for k in ("lang_pred", "score", "languages")}).drop(found)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("languages").alias("n_languages"))
