"""Toxicity of whole texts: boosted trees over dense features, calibrated by isotonic regression.

Steps, all over the labelled rows open to training:

1. Lexicon. Every training text gives the set of its forms: words, and stems of 4, 5, 6 and 8 letters
   of longer words. A form enters the lexicon if most texts that have it are toxic and that share
   can't be chance: n * KL(share || base rate) must exceed the log of the number of forms tested
   times 20 (a Chernoff bound with Bonferroni's correction). A form is left out where a stem of it
   has at least its share. Copies are counted once: of texts with equal least hash of three words
   running, one counts. The counts cover all training rows; a model keeps at most ``lexicon_size``
   entries, those of most evidence.
2. Features per text, none of which grows with it: lexicon hits per word, plain and by weight, their
   number and variety, hits near a word of second person, hits found only after undoing
   obfuscation, replaced characters, runs of one character, capitals, shouted words, exclamation
   and question marks, other punctuation, length.
3. ``GBTClassifier`` on three quarters of the training rows and ``IsotonicRegression`` on the last
   quarter turn features into a probability. Both are fitted on at most ``fit_rows`` rows, drawn by
   a hash of the id if there are more. A fiftieth of the score is the uncalibrated probability, so
   that texts on one step of the isotonic curve keep their order.

Matching happens in lower case after obfuscation is undone: digits and signs that stand for letters
beside a letter, and single letters set apart by the same sign. An Aho-Corasick automaton finds the
entries in one pass, word boundaries decide. Labels, language, source and id are no inputs.

Defined results: a null text is an empty text and is scored like one; texts of any length are read
whole. Repeated rows get equal scores. Several labels of one id: toxic if any says so; null labels
say nothing; null ids have no label and are not held out. Without training rows of both kinds every
score is the share of toxic ones (0 without any). An empty table gives an empty one. Columns
other than id and text are not read, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, slices, small, written

STEMS, LONGEST_WORD = (4, 5, 6, 8), 40
WORD = re.compile(r"[^\W\d_]+")
SHOUTED = re.compile(r"[A-Z]{3,}")
#: Characters around a hit in which a word of second person counts as near.
NEAR = 40

# Words of second person in the languages of the texts.
SECOND_PERSON = re.compile(
    r"(?<!\w)(?:you|your|yours|yourself|u|ur|du|dich|dir|dein|deine|ihr|euch|euer|tu|te|toi|ton|vous|votre|vos|tú|ti|usted|ustedes|vosotros)(?!\w)"
)
# Characters that stand for letters.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
REPLACED = re.compile(r"(?<=[^\W\d_])[013457@$]+(?=[^\W\d_])|(?<![^\s])[013457@$](?=[^\W\d_])")
MASKED = re.compile(r"[013457@$]")
SPACED = re.compile(r"(?<!\w)[^\W\d_]([.*_\- ])[^\W\d_]\1[^\W\d_](?:\1[^\W\d_])*(?!\w)")

FEATURES = (
    "hit_rate", "weighted_hit_rate", "hits", "distinct_hits", "near_second_person", "obfuscated_hit_rate",
    "replaced_rate", "run_rate", "capital_rate", "shouted_rate", "exclamation_rate", "punctuation_rate", "length",
)

_OTHER, _UPPER, _SPACE, _MARK, _PUNCT = range(5)
CLASS = np.zeros(256, np.uint8)
CLASS[ord("A") : ord("Z") + 1] = _UPPER
CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = _PUNCT
CLASS[[ord("!"), ord("?")]] = _MARK


def unmasked(low: str) -> tuple[str, int]:
    """A text in lower case with obfuscation undone, and how many characters were replaced or left out."""
    changed = 0
    if MASKED.search(low):
        low, changed = REPLACED.subn(lambda m: "".join(STANDS_FOR[c] for c in m[0]), low)
    before = len(low)
    low = SPACED.sub(lambda m: m[0].replace(m[1], ""), low)
    return low, changed + before - len(low)


def forms_of(text: str) -> set[str]:
    """The words of a text and the stems of its longer words, these with a star."""
    words = set(WORD.findall(unmasked(text.lower())[0]))
    forms = {w for w in words if len(w) <= LONGEST_WORD}
    for n in STEMS:
        forms.update(w[:n] + "*" for w in words if len(w) > n)
    return forms


def signature(text: str) -> int:
    """The least hash of three words running; near copies mostly share it."""
    words = text.lower().split()
    return min((zlib.crc32(" ".join(words[k : k + 3]).encode("utf-8", "surrogatepass")) for k in range(max(1, len(words) - 2))), default=0)


class Lexicon:
    """Entries (a star ends a stem) with their weights, and the automaton that finds them."""

    def __init__(self, entries: Sequence[tuple[str, float]]):
        self.words = ahocorasick.Automaton()
        for k, (form, weight) in enumerate(entries):
            stem = form.endswith("*")
            self._add(form.removesuffix("*"), k, stem, weight)
        self.some = len(entries) > 0
        if self.some:
            self.words.make_automaton()

    def _add(self, key: str, k: int, stem: bool, weight: float) -> None:
        known = self.words.get(key, None)
        # a word may be an entry both whole and as a stem: the stem finds both
        if known is None or stem:
            self.words.add_word(key, (k, len(key), stem, weight))

    def hits(self, text: str) -> dict[int, tuple[float, int]]:
        """Start of each hit -> (weight, entry); of several entries at one place the one of most weight."""
        found: dict[int, tuple[float, int]] = {}
        if not self.some:
            return found
        for last, (k, length, stem, weight) in self.words.iter(text):
            begin = last + 1 - length
            if begin and text[begin - 1].isalnum() or not stem and last + 1 < len(text) and text[last + 1].isalnum():
                continue
            found[begin] = max(found.get(begin, (-math.inf, -1)), (weight, k))
        return found


def features_of(text: str | None, lexicon: Lexicon) -> list[float]:
    """The values of ``FEATURES``."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = CLASS[raw]
    counts = np.bincount(kinds, minlength=5)
    space = kinds == _SPACE
    words = max(1, int(np.count_nonzero(space[:-1] & ~space[1:])) + int(len(raw) > 0 and not space[0]))
    size = max(1, len(raw))
    runs = np.count_nonzero((raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & ~space[2:])
    low = text.lower()
    plain, changed = unmasked(low)
    hits = lexicon.hits(plain)
    hidden = max(0, len(hits) - len(lexicon.hits(low))) if hits and changed else 0
    near = sum(bool(SECOND_PERSON.search(plain, max(0, at - NEAR), at + NEAR)) for at in hits)
    return [
        len(hits) / words, sum(w for w, _ in hits.values()) / words, math.log1p(len(hits)), math.log1p(len({k for _, k in hits.values()})),
        near / max(1, len(hits)), hidden / words, changed / words, runs / size, counts[_UPPER] / size, len(SHOUTED.findall(text)) / words,
        counts[_MARK] / size, counts[_PUNCT] / size, math.log1p(words),
    ]


def with_features(rows: DataFrame, lexicon: list[tuple[str, float]]) -> DataFrame:
    """``rows`` with ``text`` replaced by ``features``."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Lexicon(lexicon)
        for batch in slices(batches):
            found = [features_of(t, words) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(found, pa.list_(pa.float64()))], [*kept, "features"])

    schema = T.StructType([*rows.select(*kept).schema.fields, T.StructField("features", T.ArrayType(T.DoubleType()))])
    return rows.select(*kept, "text").mapInArrow(run, schema)


def held_out(ident: Column) -> Column:
    """Rows never learned from: the id's checksum leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(ident.cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, broadcast_bytes: int) -> DataFrame:
    """uid, doc_id, text, toxic (0 or 1) of the labelled rows that are not held out."""
    marks = pick(labels, label_id=id_column, toxic=label_column).where("label_id is not null and toxic is not null")
    marks = marks.where(~held_out(F.col("label_id"))).groupBy("label_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    rows = pick(docs, doc_id=id_column, text=text_column).withColumn("uid", F.monotonically_increasing_id())
    return rows.join(small(marks, 48, broadcast_bytes), F.col("doc_id") == F.col("label_id")).select(
        "uid", "doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic"
    )


def form_counts(rows: DataFrame) -> DataFrame:
    """form, n, toxic: texts that have the form, and the toxic ones; near copies count once."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            signs = [signature(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["uid"], batch["toxic"], pa.array(signs, pa.int64())], ["uid", "toxic", "sign"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both: list[Counter[str]] = [Counter(), Counter()]

        def counted() -> pa.RecordBatch:
            forms = list(both[0].keys() | both[1].keys())
            toxic = [both[1][f] for f in forms]
            out = pa.RecordBatch.from_arrays(
                [pa.array(forms, pa.string()), pa.array([both[0][f] + t for f, t in zip(forms, toxic, strict=True)], pa.int64()), pa.array(toxic, pa.int64())],
                ["form", "n", "toxic"],
            )
            both[0].clear(), both[1].clear()
            return out

        for batch in slices(batches):
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                both[toxic].update(forms_of(text))
            if len(both[0]) + len(both[1]) > 500_000:
                yield counted()
        yield counted()

    one = rows.mapInArrow(sign, "uid long, toxic int, sign long").groupBy("sign", "toxic").agg(F.min("uid").alias("uid"))
    parts = rows.join(one.select("uid"), "uid").select("text", "toxic").mapInArrow(count, "form string, n long, toxic long")
    return parts.groupBy("form").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def significant_forms(counts: DataFrame, base: float, tested: int) -> DataFrame:
    """form, weight, evidence of the lexicon."""
    share = F.col("toxic") / F.col("n")
    apart = share * F.log(share / base) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    rated = counts.where(share >= max(0.5, base)).withColumn("share", share).withColumn("evidence", F.col("n") * apart)
    kept = rated.where(F.col("evidence") > math.log(20 * max(tested, 1)))
    bare = F.regexp_replace("form", r"\*$", "")
    stems = F.filter(F.array(*[F.when(F.length(bare) > n, F.concat(F.substring(bare, 1, n), F.lit("*"))) for n in STEMS]), lambda x: x.isNotNull())
    of = kept.select("form", "share", F.explode(stems).alias("stem"))
    better = of.join(kept.select(F.col("form").alias("stem"), F.col("share").alias("of_stem")), "stem").where("of_stem >= share").select("form").distinct()
    weight = F.log((F.col("toxic") + 1) / (F.col("n") - F.col("toxic") + 1))
    return kept.join(better, "form", "left_anti").select("form", weight.alias("weight"), "evidence")


def learn_lexicon(rows: DataFrame, base: float, lexicon_size: int) -> list[tuple[str, float]]:
    counts = written(form_counts(rows), "form-counts")
    best = significant_forms(counts, base, counts.count()).orderBy(F.desc("evidence"), "form").limit(lexicon_size)
    return [(r.form, r.weight) for r in best.collect()]


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
    threshold: float = 0.7, fit_rows: int = 500_000, lexicon_size: int = 4096, trees: int = 20, depth: int = 3, broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """One row per document: its id, held_out, score (0 to 1) and predicted (1 from ``threshold`` on)."""
    rows = pick(docs, doc_id=id_column, text=text_column)
    flagged = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    train = written(training_rows(docs, labels, id_column, text_column, label_column, broadcast_bytes), "toxicity-training")
    n, toxic = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < n:
        found = flagged.select("doc_id", "held_out", F.lit(toxic / max(n, 1)).cast("double").alias("score"))
    else:
        lexicon = learn_lexicon(train, toxic / n, lexicon_size)
        draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
        chosen = train.where(draw < math.ceil(min(1.0, fit_rows / n) * (1 << 20)))
        fold = F.when(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0, "calibrate").otherwise("fit")
        known = written(with_features(chosen.select(F.col("toxic").cast("double").alias("label"), fold.alias("fold"), "text"), lexicon), "toxicity-features")
        fits = {r.fold: r.kinds for r in known.groupBy("fold").agg(F.count_distinct("label").alias("kinds")).collect()}
        whole = min(fits.get("fit", 0), fits.get("calibrate", 0)) < 2  # too few rows to part them
        vectors = known.select("label", "fold", array_to_vector("features").alias("features"))
        boosted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, maxBins=64, seed=13).fit(vectors if whole else vectors.where("fold = 'fit'"))
        raw = vector_to_array("probability")[1].alias("raw")
        tested = boosted.transform(vectors if whole else vectors.where("fold = 'calibrate'")).select("label", raw)
        steps = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="step").fit(tested)
        scored = boosted.transform(with_features(flagged, lexicon).select("doc_id", "held_out", array_to_vector("features").alias("features")))
        found = steps.transform(scored.select("doc_id", "held_out", raw))
        found = found.select("doc_id", "held_out", (0.98 * F.col("step") + 0.02 * F.col("raw")).alias("score"))
    return found.select(F.col("doc_id").alias(id_column), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
