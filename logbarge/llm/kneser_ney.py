"""Quality classifier: interpolated modified Kneser-Ney model of characters, one per language.

Trusted text is that of documents whose labels all say quality 1 and none toxic. Nine tenths of it
(by a hash of the id) train, one tenth calibrates. With counts c and discounts D1, D2, D3+ taken
from the counts of counts of each order and language,

    p(w | h) = max(c(hw) - D(c(hw)), 0) / c(h) + g(h) p(w | h')

where h' is h without its first character, g(h) the mass the discounts free, and counts below the
highest order are numbers of different left neighbours. An unseen h passes on to h'; below single
characters stands a uniform distribution over the language's characters and one unknown.

A document's score is the mean of -ln p over its n characters and its end. Scores of short texts
scatter more than those of long ones, so distances are taken in units of w(n) = sqrt(1 + ``scatter``
/ n). A document is rejected above the limit of its language and length, which comes from quantiles
of the calibration documents:

    limit = median + w(n) * max(``spread`` * upper quantile of (score - median) / w, floor)

The floor, ``margin`` * median / sqrt(number of calibration documents), matters for few of them only.

Counts, contexts, discounts and probabilities are tables joined on (language, gram), so the model
is as large as the corpus makes it. Tasks emit each gram once per block of text. The probabilities
of all grams of the corpus are shipped to the tasks if they take at most ``broadcast_bytes``;
beyond that, documents emit their grams, which are joined with the probabilities and summed. Both
ways give the same scores.

Defined results: null and empty texts, and texts of a language without trusted text, have no score
and are kept; a null language is a language of its own; a language without calibration documents
takes the mean of the others' medians and distances, or rejects nothing if there is none; repeated rows are
scored each. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, slices, small, written

#: Characters per gram and bits per character; code points beyond the bits share codes.
ORDER, BITS = 4, 15
BEGIN, END = 1, 2
#: Characters that array work takes at once, grams counted between two folds, and that one block of counts covers.
CHUNK, FOLD, BLOCK = 1 << 18, 1 << 19, 1 << 24


@dataclass(frozen=True)
class Limits:
    upper: float = 0.9
    spread: float = 4.0
    margin: float = 0.3
    scatter: float = 300.0


def codes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    half = 1 << BITS - 1
    return np.where(points < 1 << BITS, points, half + points % half)


def grams_of(text: str) -> Iterator[np.ndarray]:
    """Keys of the grams that end at each character and at the end mark, for at most CHUNK characters at once."""
    before = np.full(ORDER - 1, BEGIN, np.int64)
    for begin in range(0, len(text), CHUNK):
        codes = codes_of(text[begin : begin + CHUNK])
        if begin + CHUNK >= len(text):
            codes = np.append(codes, END)
        codes = np.concatenate([before, codes])
        before = codes[1 - ORDER :]
        keys = np.zeros(len(codes) - ORDER + 1, np.int64)
        for k in range(ORDER):
            keys = keys << BITS | codes[k : k + len(keys)]
        yield keys


def trust(labels: DataFrame) -> DataFrame:
    """(label_id, trusted) of all labelled documents."""
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) != 1), F.lit(False))
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.min(good).alias("trusted"))


def count_grams(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): how often training text has each gram of ``rows`` (lang, text, part); 0 if only others have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, list[np.ndarray]]] = {}
        size = 0

        def folded() -> None:
            for lang, parts in held.items():
                place, grams = pd.factorize(np.concatenate(parts["keys"]))
                held[lang] = {"keys": [grams], "n": [np.bincount(place, np.concatenate(parts["n"]), len(grams))]}

        def flushed() -> Iterator[pa.RecordBatch]:
            folded()
            for lang, parts in held.items():
                grams = parts["keys"][0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(parts["n"][0].astype(np.int64))],
                    ["lang", "gram", "n"],
                )
            held.clear()

        fresh = 0
        for batch in slices(batches):
            for lang, text, part in zip(batch["lang"].to_pylist(), batch["text"], batch["part"].to_pylist(), strict=True):
                for keys in grams_of(text.as_py() or ""):
                    parts = held.setdefault(lang, {"keys": [], "n": []})
                    parts["keys"].append(keys)
                    parts["n"].append(np.full(len(keys), part == "train", np.int32))
                    fresh += len(keys)
                    size += len(keys)
                    if fresh >= FOLD:
                        folded()
                        fresh = 0
                if size >= BLOCK:
                    yield from flushed()
                    size = fresh = 0
        yield from flushed()

    return rows.mapInArrow(count, "lang string, gram long, n long")


def log_probabilities(counts: DataFrame) -> DataFrame:
    """(lang, gram, logp) of every gram in ``counts`` (lang, gram, n), for languages with training text."""
    seen = {ORDER: counts.where("n > 0").select("lang", "gram", F.col("n").alias("c"))}
    for k in range(ORDER - 1, 0, -1):
        suffix = _suffix(F.col("gram"), k).alias("gram")
        seen[k] = written(seen[k + 1].select("lang", suffix).groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("c")), f"grams-{k}")
    characters = seen[1].groupBy("lang").agg((1 / (F.count(F.lit(1)) + 1.0)).alias("lower"))
    wanted = counts.join(characters.select("lang"), "lang", "left_semi").select("lang", "gram")

    lower = None
    for k in range(1, ORDER + 1):
        one, two, three = (F.col("c") == 1), (F.col("c") == 2), (F.col("c") >= 3)
        times = lambda test: F.sum(F.when(test, 1.0).otherwise(0.0))
        discounts = seen[k].groupBy("lang").agg(*[(times(F.col("c") == i) + 0.5).alias(f"n{i}") for i in (1, 2, 3, 4)])
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        discounts = discounts.select("lang", *[
            F.least(F.greatest(i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"), F.lit(0.1)), F.lit(float(i))).alias(f"d{i}")
            for i in (1, 2, 3)
        ])
        contexts = seen[k].groupBy("lang", F.shiftright("gram", BITS).alias("h")).agg(
            F.sum("c").alias("total"), times(one).alias("m1"), times(two).alias("m2"), times(three).alias("m3")
        ).join(discounts, "lang").select(
            "lang", "h", "total", "d1", "d2", "d3",
            ((F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3")) / F.col("total")).alias("free"),
        )
        grams = wanted.select("lang", _suffix(F.col("gram"), k).alias("gram")).distinct() if k < ORDER else wanted
        rows = grams.join(seen[k], ["lang", "gram"], "left").withColumn("h", F.shiftright("gram", BITS)).join(contexts, ["lang", "h"], "left")
        if lower is None:
            rows = rows.join(characters, "lang")
        else:
            rows = rows.withColumn("tail", _suffix(F.col("gram"), k - 1)).join(lower, ["lang", "tail"])
        off = F.when(one, F.col("d1")).when(two, F.col("d2")).otherwise(F.col("d3"))
        own = F.coalesce(F.greatest(F.col("c") - off, F.lit(0.0)) / F.col("total"), F.lit(0.0))
        p = F.when(F.col("total").isNull(), F.col("lower")).otherwise(own + F.col("free") * F.col("lower"))
        done = rows.select("lang", "gram", p.alias("p"))
        lower = written(done, f"probabilities-{k}").select("lang", F.col("gram").alias("tail"), F.col("p").alias("lower"))
    return lower.select("lang", F.col("tail").alias("gram"), F.log("lower").alias("logp"))


def _suffix(gram: Column, k: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << BITS * k) - 1))


class Scorer:
    """Scores texts by sorted grams and their log probabilities, per language."""

    def __init__(self, table: pa.Table):
        frame = table.to_pandas()
        self.models = {}
        for lang, rows in frame.groupby("lang"):
            order = np.argsort(rows["gram"].to_numpy())
            self.models[lang] = rows["gram"].to_numpy()[order], rows["logp"].to_numpy()[order]

    def scores(self, langs: list[str], texts: list[str | None]) -> list[float | None]:
        out: list[float | None] = [None] * len(texts)
        by_lang: dict[str, list[int]] = {}
        for k, (lang, text) in enumerate(zip(langs, texts, strict=True)):
            if text and lang in self.models:
                by_lang.setdefault(lang, []).append(k)
        for lang, places in by_lang.items():
            grams, logp = self.models[lang]
            sums, sizes = np.zeros(len(places)), np.zeros(len(places), np.int64)
            keys, owners, size = [], [], 0
            parts = ((n, part) for n, k in enumerate(places) for part in grams_of(texts[k]))
            for n, part in parts:
                keys.append(part)
                owners.append(n)
                size += len(part)
                if size >= CHUNK:
                    self._add(grams, logp, keys, owners, sums, sizes)
                    keys, owners, size = [], [], 0
            self._add(grams, logp, keys, owners, sums, sizes)
            for n, k in enumerate(places):
                out[k] = float(-sums[n] / sizes[n])
        return out

    @staticmethod
    def _add(grams: np.ndarray, logp: np.ndarray, keys: list[np.ndarray], owners: list[int], sums: np.ndarray, sizes: np.ndarray) -> None:
        if keys:
            lengths = np.array([len(x) for x in keys])
            place, own = pd.factorize(np.concatenate(keys))
            each = logp[np.searchsorted(grams, own)][place]
            np.add.at(sums, owners, np.add.reduceat(each, np.cumsum(lengths) - lengths))
            np.add.at(sizes, owners, lengths)


def score(docs: DataFrame, probabilities: DataFrame, lang: str, text: str, broadcast_bytes: int) -> DataFrame:
    """All rows and columns of ``docs`` as ``row``, with ``lang`` and ``score`` (null where there is none)."""
    rows = docs.select(
        F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row"), _lang(docs[quoted(lang)]).alias("lang"), docs[quoted(text)].alias("text")
    )
    if probabilities.count() * 48 <= broadcast_bytes:
        model = docs.sparkSession.sparkContext.broadcast(probabilities.toArrow())
        schema = T.StructType([rows.schema["row"], rows.schema["lang"], T.StructField("score", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(model.value)
            for batch in slices(batches):
                found = scorer.scores(batch["lang"].to_pylist(), batch["text"].to_pylist())
                yield pa.RecordBatch.from_arrays([batch["row"], batch["lang"], pa.array(found, pa.float64())], schema.names)

        return rows.mapInArrow(run, schema)

    keyed = written(rows.withColumn("uid", F.monotonically_increasing_id()), "to-score")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for uid, lang, text in zip(batch["uid"].to_pylist(), batch["lang"].to_pylist(), batch["text"], strict=True):
                for keys in grams_of(text.as_py() or ""):
                    grams, times = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([uid] * len(grams), pa.int64()), pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(times)],
                        ["uid", "lang", "gram", "times"],
                    )

    each = keyed.select("uid", "lang", "text").mapInArrow(emit, "uid long, lang string, gram long, times long")
    mean = (-F.sum(F.col("times") * F.col("logp")) / F.sum("times")).alias("score")
    scores = each.join(probabilities, ["lang", "gram"]).groupBy("uid").agg(mean)
    return keyed.join(scores, "uid", "left").select("row", "lang", "score")


def _lang(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def judged(
    docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), id_column: str = "doc_id", lang_column: str = "lang",
    text_column: str = "text", broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``lang``, ``score``, ``limit``, ``kept``."""
    marks = small(trust(labels), 48, broadcast_bytes)
    held_out = F.pmod(F.xxhash64("label_id"), F.lit(10)) == 0
    part = F.when(F.col("trusted"), F.when(held_out, "test").otherwise("train"))
    marked = docs.select(
        docs[quoted(id_column)].alias("doc_id"), _lang(docs[quoted(lang_column)]).alias("lang"), docs[quoted(text_column)].alias("text")
    ).join(marks, F.col("doc_id") == F.col("label_id"), "left").select("lang", "text", part.alias("part"))
    counts = count_grams(marked).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    probabilities = log_probabilities(written(counts, "gram-counts"))

    width = lambda text: F.sqrt(1 + limits.scatter / (F.coalesce(F.length(text), F.lit(0)) + 1))
    tested = score(marked.where("part = 'test'"), probabilities, "lang", "text", broadcast_bytes).where("score is not null")
    tested = written(tested.select("lang", "score", width("row.text").alias("width")), "calibration")
    middles = tested.groupBy("lang").agg(F.percentile_approx("score", 0.5, 10000).alias("middle"))
    upper = F.percentile_approx((F.col("score") - F.col("middle")) / F.col("width"), limits.upper, 10000)
    floor = limits.margin * F.col("middle") / F.sqrt("times")
    bounds = tested.join(middles, "lang").groupBy("lang", "middle").agg(upper.alias("upper"), F.count(F.lit(1)).alias("times")).select(
        "lang", "middle", F.greatest(limits.spread * F.col("upper"), floor).alias("reach")
    )
    bounds = written(bounds, "limits")
    general = bounds.agg(F.avg("middle"), F.avg("reach")).first()
    found = score(docs, probabilities, lang_column, text_column, broadcast_bytes)
    found = found.join(small(bounds, 160, broadcast_bytes).withColumnRenamed("lang", "of"), F.col("lang") == F.col("of"), "left")
    middle, reach = (F.coalesce(c, F.lit(x).cast("double")) for c, x in zip(("middle", "reach"), general, strict=True))
    limit = middle + width(F.col("row")[text_column]) * reach
    return found.select("row", "lang", "score", limit.alias("limit"), F.coalesce(F.col("score") <= limit, F.lit(True)).alias("kept"))


def quality_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", **options: object) -> DataFrame:
    """doc_id, lang, perplexity, limit (as a perplexity) and kept, one row per document."""
    return judged(docs, labels, id_column=id_column, **options).select(
        F.col("row")[id_column].alias("doc_id"), "lang", F.exp("score").alias("perplexity"), F.exp("limit").alias("limit"), "kept"
    )


def good_documents(docs: DataFrame, labels: DataFrame, **options: object) -> DataFrame:
    """The rows of ``docs``, all columns, that are not rejected."""
    return judged(docs, labels, **options).where("kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])
