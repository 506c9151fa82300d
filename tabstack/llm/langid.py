"""Language identification by multilingual mixture inference (operator 2).

Training: letter trigrams of labelled rows give one smoothed trigram
distribution per language.  Prediction: a document's trigrams are seen as
drawn from a mixture of the languages; expectation-maximisation estimates the
proportions.  Languages enter the set in order of their proportion as long as
the log-likelihood of the mixture rises by more than a penalty per language.

Training rows may be a sample: at most about ``sample_per_lang`` rows of each
language, chosen by a hash of the id (all rows below that).  The model's size
is languages x 64^3, whatever the input.

Edge cases: null or letterless text is ``und`` with score 0; with no labelled
row everything is ``und``.  Equal likelihoods go to the language that sorts
first.  Rows are independent, so repeated rows give repeated results; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstack.llm.common import map_batches

SYMBOLS = 64
GRAMS = SYMBOLS ** 3
SAMPLE_PER_LANG = 5_000
SMOOTHING = 0.05
PENALTY = 3.0      # log-likelihood units per ln(number of trigrams) and added language
ROUNDS = 25
NOISE = 6.0        # a fit's allowance for chance, over the root of the number of trigrams
BELOW = 2.5        # least distance of a bar from the median fit, in log-likelihood per trigram
SPREADS = 4.0      # the same in distances from the median to the lowest twentieth


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Code point -> symbol: 0 no letter, 1..26 a..z, 27..63 other letters by remainder."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            out[c] = c - 96 if "a" <= ch <= "z" else 27 + c % 37
    return out


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigram codes of ``text`` and their counts; none without a letter."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not text:
        return none
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    s = np.zeros(len(points) + 2, dtype=np.uint32)
    s[1:-1] = symbol_table()[points]
    if not s.any():
        return none
    keep = (s[1:] != 0) | (s[:-1] != 0)     # a run of other characters is one gap
    s = np.concatenate([s[:1], s[1:][keep]])
    code = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
    if len(code) > 40_000:
        full = np.bincount(code, minlength=GRAMS)
        grams = np.flatnonzero(full)
        return grams, full[grams]
    grams, counts = np.unique(code, return_counts=True)
    return grams.astype(np.int64), counts


def proportions(p: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """EM: mixture weights of the columns of ``p`` (gram x language) and the log-likelihood."""
    k = p.shape[1]
    q = np.full(k, 1.0 / k)
    n = counts.sum()
    if k > 1:
        for _ in range(rounds):
            new = q * (p.T @ (counts / (p @ q))) / n
            done = np.abs(new - q).max() < 1e-4
            q = new
            if done:
                break
    return q, float(counts @ np.log(p @ q))


def infer(model: np.ndarray, grams: np.ndarray, counts: np.ndarray, penalty: float = PENALTY) -> list[tuple[int, float]]:
    """Languages of one document (column of ``model``, share), largest share first.

    ``model`` holds probabilities, one column per language.
    """
    p, c = model[grams], counts.astype(np.float64)
    best = int(np.argmax(c @ np.log(p)))
    chosen, shares = [best], np.ones(1)
    if p.shape[1] > 1:
        fee = penalty * np.log(1 + c.sum())
        now = float(c @ np.log(p[:, best]))
        q, full = proportions(p, c)
        if full - now > fee:    # else no set can pay for a second language
            order = [int(j) for j in np.argsort(-q, kind="stable")]
            reached = -np.inf
            for k in range(1, len(order) + 1):
                part, value = proportions(p[:, order[:k]], c)
                if value - fee * (k - 1) <= reached:
                    break
                reached, chosen, shares = value - fee * (k - 1), order[:k], part
    return sorted(((j, float(x)) for j, x in zip(chosen, shares)), key=lambda t: (-t[1], t[0]))


def fit(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_per_lang: int = SAMPLE_PER_LANG) -> tuple[list[str], np.ndarray]:
    """Language names (sorted) and trigram probabilities (gram x language) from the rows where ``train`` holds."""
    rows = docs.filter(train & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((GRAMS, 0))
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, sample_per_lang / sizes[k])))])
    place = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.filter(place < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros(GRAMS, np.int64) for k in langs}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                grams, counts = trigrams(text.as_py())
                sums[lang][grams] += counts
        for k, v in sums.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.string()), pa.array(at), pa.array(v[at])],
                                             names=["lang", "gram", "n"])

    counted = (map_batches(sample, count, "lang string, gram bigint, n bigint")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())   # at most languages x 64^3 rows
    model = np.full((GRAMS, len(langs)), SMOOTHING)
    for j, k in enumerate(langs):
        own = counted[counted["lang"] == k]
        model[own["gram"].to_numpy(np.int64), j] += own["n"].to_numpy(np.float64)
    return langs, model / model.sum(axis=0)


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
            keep: tuple[str, ...] = (), penalty: float = PENALTY, with_fit: bool = False) -> DataFrame:
    """``id_col``, the columns in ``keep``, ``lang_pred``, ``score`` (its share) and ``shares`` of every row.

    ``with_fit`` adds ``fit``: the log-likelihood of a trigram under the mixture
    and an allowance for short texts, null where nothing was found.
    """
    held = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))
    src = docs.select(F.col(text_col).alias("body"), F.struct(id_col, *keep).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = held.value.astype(np.float64)
        for b in batches:
            names, scores, sets, fits = [], [], [], []
            for text in b.column(0):
                grams, counts = trigrams(text.as_py())
                found = infer(p, grams, counts, penalty) if len(grams) and langs else []
                names.append(langs[found[0][0]] if found else "und")
                scores.append(min(1.0, found[0][1]) if found else 0.0)
                sets.append([{"lang": langs[j], "share": x} for j, x in found])
                if with_fit:
                    mixed = p[grams][:, [j for j, _ in found]] @ np.array([x for _, x in found])
                    fits.append(float(counts @ np.log(mixed)) / counts.sum() + NOISE / np.sqrt(counts.sum()) if found else None)
            kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
            more = [pa.array(fits, pa.float64())] if with_fit else []
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array(sets, kind), *more], names=["row", "lang_pred", "score", "shares", *extra])

    extra = ["fit"] if with_fit else []
    row = src.schema["row"].dataType.simpleString()
    out = map_batches(src, run, f"row {row}, lang_pred string, score double, shares array<struct<lang:string,share:double>>" + (", fit double" if with_fit else ""))
    return out.select("row.*", "lang_pred", "score", "shares", *extra)


def bars(docs: DataFrame, langs: list[str], model: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
         lang_col: str = "lang") -> dict[str, float]:
    """Of each language the fit far below that of the labelled rows ``docs``; up to a twentieth of them may be wrong.

    The rows should not be those the model was learned from, which fit it too well.
    """
    named = docs.filter(F.col(lang_col).isNotNull()).select(id_col, text_col, F.col(lang_col).cast("string").alias("_label"))
    fits = predict(named, langs, model, id_col, text_col, keep=("_label",), with_fit=True).filter("fit is not null")
    found = fits.groupBy("_label").agg(F.percentile_approx("fit", [0.5, 0.05], 10_000).alias("q")).collect()    # a row per language
    return {r["_label"]: r.q[0] - max(BELOW, SPREADS * (r.q[0] - r.q[1])) for r in found}
