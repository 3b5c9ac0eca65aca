"""Language identification: a character n-gram scoring job and the decision ladder.

Any frame ``(row_key, code, score)`` can take the place of the built-in scorer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from talkloom.functions import languages as fixed
from talkloom.functions.languages import language_label, text_array
from talkloom.functions.text import casefold, clean_text
from talkloom.session import settle

UNDETERMINED = "und"
# A profile of this many short n-grams stays well under 200 MB when broadcast.
MAX_BROADCAST_PROFILE = 2_000_000
# Grams of texts that vote from a broadcast part of a larger profile, and the sketch's items for each of them.
FREQUENT_GRAMS = 20_000
SKETCH_ITEMS_PER_GRAM = 4
# Text whose grams are counted at once, and what is found per text.
SLICE_BYTES = 1 << 20
GRAM_LIST = T.ArrayType(T.StructType([T.StructField("gram", T.StringType()), T.StructField("times", T.LongType())]))


@dataclass(frozen=True)
class LanguageSettings:
    supported: Sequence[str] = fixed.SUPPORTED_LANGUAGES
    order: Sequence[str] = fixed.LANGUAGE_ORDER
    label_map: Mapping[str, str] = field(default_factory=lambda: dict(fixed.LABEL_MAP))
    confidence_threshold: float = fixed.CONFIDENCE_THRESHOLD
    mixed_confidence_threshold: float = fixed.MIXED_CONFIDENCE_THRESHOLD
    top_k: int = fixed.TOP_K
    min_chars: int = fixed.MIN_CHARS
    cues: Sequence[str] = fixed.HILIGAYNON_CUES
    use_cues: bool = True
    batch_reasons: Sequence[str] = fixed.BATCH_REASONS
    batch_low_confidence: bool = True
    max_languages: int = fixed.MAX_LANGUAGES_PER_ROW


# ---- scorer ----------------------------------------------------------------


def ngrams(texts: DataFrame, n: int = 3, key: str = "row_key", text: str = "text", combine: bool = False) -> DataFrame:
    """(key, gram, times): the character n-grams of each cleaned lower-case text and how often it has them.

    Grams are counted where the text is, an Arrow batch at a time, so what Spark explodes, joins and
    shuffles is a row per distinct gram of a text and not one per character. With ``combine``
    the texts of a batch that share a key are counted together. A text shorter than ``n`` gives
    one NULL gram.
    """
    folded = texts.select(F.col(key), clean_text(text).alias("_clean")).select(key, F.lower("_clean").alias("_text"))
    listed = T.StructType([T.StructField(key, folded.schema[key].dataType), T.StructField("_grams", GRAM_LIST)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
            cuts = np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ends)]):
                keys, part = batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo)
                owners = np.arange(hi - lo)
                if combine:
                    encoded = keys.dictionary_encode("encode")
                    owners, keys = encoded.indices.to_numpy(), encoded.dictionary
                yield pa.RecordBatch.from_arrays([keys, _gram_lists(part, owners, len(keys), n)], [key, "_grams"])

    counted = folded.mapInArrow(count, listed).select(key, F.explode_outer("_grams").alias("_g"))
    return counted.select(key, "_g.gram", "_g.times")


def _gram_lists(texts: pa.Array, owners: np.ndarray, groups: int, n: int) -> pa.ListArray:
    """Per owner 0 .. groups - 1 the (gram, times) of its texts. ``owners`` names the owner of each text."""
    length = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
    # where each gram starts, and whose it is
    most = np.maximum(length - n + 1, 0)
    start = np.repeat(np.cumsum(length) - length - (np.cumsum(most) - most), most) + np.arange(most.sum())
    owner = np.repeat(owners, most)
    used = np.zeros(int(chars.max(initial=0)) + 1, bool)
    used[chars] = True
    alphabet, rank = np.flatnonzero(used), np.cumsum(used, dtype=np.int32) - 1
    rank, base = rank[chars], max(len(alphabet), 1)
    size = groups * base**n
    if size < 1 << 63:  # one number per (owner, gram): the characters are its digits
        number = owner.astype(np.uint32 if size < 1 << 32 else np.int64)
        for i in range(n):
            number *= number.dtype.type(base)
            number += rank[start + i].astype(number.dtype)
        if size <= 4 * len(number):
            times = np.bincount(number)
            number = np.flatnonzero(times)
            times = times[number]
        else:
            number.sort()
            at = np.flatnonzero(np.append(True, number[1:] != number[:-1])[: len(number)])
            times = np.diff(np.append(at, len(number)))
            number = number[at]
        digits = []
        for _ in range(n):
            number, digit = np.divmod(number, number.dtype.type(base))
            digits.append(digit)
        owner, code = number, alphabet[np.stack(digits[::-1], 1).astype(np.int64)].astype(np.uint32)
    else:  # long grams of very many characters
        rows, times = np.unique(np.column_stack([owner, *(chars[start + i] for i in range(n))]), axis=0, return_counts=True)
        owner, code = rows[:, 0], np.ascontiguousarray(rows[:, 1:], np.uint32)
    width = 1 + (code >= 0x80).astype(np.int32) + (code >= 0x800) + (code >= 0x10000)
    ends = np.concatenate([[0], np.cumsum(width.sum(1))]).astype(np.int32)
    gram = pa.StringArray.from_buffers(len(code), pa.py_buffer(ends), pa.py_buffer(code.tobytes().decode("utf-32-le").encode()))
    bounds = np.searchsorted(owner, np.arange(groups + 1).astype(owner.dtype)).astype(np.int32)
    return pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays([gram, pa.array(times, pa.int64())], ["gram", "times"]))


def train_profile(labelled: DataFrame, n: int = 3, code: str = "code", text: str = "text") -> DataFrame:
    """(gram, code): the language every n-gram is most frequent in, ties by code.

    Counts are combined in the map tasks, and the pick per gram passes a group limit
    below its exchange, so frequent grams do not pile up.
    """
    counted = (
        ngrams(labelled.withColumnRenamed(code, "code"), n, key="code", text=text, combine=True)
        .filter("gram is not null")
        .groupBy("gram", "code")
        .agg(F.sum("times").alias("count"))
    )
    best = Window.partitionBy("gram").orderBy(F.desc("count"), "code")
    return counted.withColumn("_r", F.row_number().over(best)).filter("_r = 1").select("gram", "code")


def frequent_grams(grams: DataFrame, most: int) -> DataFrame:
    """(gram): the about ``most`` grams of the most texts, from a sketch of fixed size that tasks merge."""
    sketch = f"approx_top_k(gram, {int(most)}, {int(most) * SKETCH_ITEMS_PER_GRAM})"
    top = grams.filter("gram is not null").agg(F.expr(sketch).alias("top"))
    return top.select(F.explode("top.item").alias("gram"))


def _votes_by_shuffle(grams: DataFrame, profile: DataFrame, n: int) -> DataFrame:
    """(row_key, code, votes) for a profile that is too large to broadcast.

    Votes of the frequent grams are cast and summed in the task that counted the text, from
    a broadcast part of the profile; only the others are combined per text and go to the
    shuffle, so no gram key there has a row per text. What needs no look-up any more is
    dealt by the text.
    """
    frequent = settle(profile.join(F.broadcast(frequent_grams(grams, FREQUENT_GRAMS)), "gram", "left_semi"))
    known = frequent.select("gram", F.struct(F.col("code").alias("code")).alias("_known"))
    seen = grams.join(F.broadcast(known), "gram", "left")
    done = F.col("_known").isNotNull() | F.col("gram").isNull()
    combined = (
        seen.select("row_key", F.col("_known.code").alias("_code"), F.when(~done, F.col("gram")).alias("gram"), "times")
        .groupBy("row_key", "_code", "gram")
        .agg(F.sum("times").alias("times"))
    )
    # no gram of n characters equals a key that is longer
    filler = F.concat(F.lit("-" * (n + 1)), F.col("row_key").cast("string"))
    rest = profile.filter(F.char_length("gram") == n).withColumnRenamed("gram", "_gram")
    voted = combined.withColumn("_gram", F.coalesce("gram", filler)).join(rest, "_gram", "left")
    return voted.groupBy("row_key", F.coalesce("_code", "code").alias("code")).agg(F.sum("times").alias("votes"))


def score_texts(
    texts: DataFrame, profile: DataFrame, n: int = 3, keep_votes: bool = False, broadcast_rows: int | None = None
) -> DataFrame:
    """(row_key, code, score): share of a text's n-gram votes per language.

    The profile is written out once, then broadcast only when its counted size allows
    (``broadcast_rows``, ``MAX_BROADCAST_PROFILE`` by default); past that, frequent grams
    vote from a broadcast part of it and the rest by shuffle. Votes are summed per text and
    language in the map task that counted it, so the shuffle carries a few counters per
    text, for any number of languages. A text without any vote scores ``und``.
    """
    profile = settle(profile.select("gram", "code"))
    grams = ngrams(texts, n)
    most = MAX_BROADCAST_PROFILE if broadcast_rows is None else broadcast_rows
    if profile.count() <= most:
        voted = grams.join(F.broadcast(profile), "gram", "left")
        votes = voted.groupBy("row_key", "code").agg(F.sum("times").alias("votes"))
    else:
        votes = _votes_by_shuffle(grams, profile, n)
    cast = F.when(F.col("code").isNotNull(), F.col("votes"))
    listed = votes.groupBy("row_key").agg(
        F.collect_list(F.when(F.col("code").isNotNull(), F.struct("code", "votes"))).alias("_listed"),
        F.coalesce(F.sum(cast), F.lit(0)).alias("total_votes"),
    )
    none = F.struct(F.lit(UNDETERMINED).alias("code"), F.lit(0).cast("bigint").alias("votes"))
    long = listed.select(
        "row_key",
        "total_votes",
        F.explode(F.when(F.size("_listed") > 0, F.col("_listed")).otherwise(F.array(none))).alias("p"),
    )
    score = F.when(F.col("total_votes") > 0, F.col("p.votes") / F.col("total_votes")).otherwise(F.lit(1.0))
    extra = [F.col("p.votes").alias("votes"), F.col("total_votes")] if keep_votes else []
    return long.select("row_key", F.col("p.code").alias("code"), score.cast("double").alias("score"), *extra)


# ---- ladder ----------------------------------------------------------------


def early_reason(text: Column, settings: LanguageSettings) -> Column:
    """Reasons that need no score: too short, then a cue. ``text`` is a column of cleaned text, since it is read
    more than once; it is folded once for all cues."""
    cue = F.lit(False)
    if settings.use_cues and settings.cues:
        cue = casefold(text).rlike("|".join(re.escape(word) for word in settings.cues))
    return F.when(F.char_length(text) < settings.min_chars, F.lit("too_short")).when(
        cue, F.lit("possible_hiligaynon")
    )


def collect_scores(scores: DataFrame, settings: LanguageSettings) -> DataFrame:
    """(row_key, ranked): the top-k scores of a text as (language, score), best first.

    The cut to k comes before codes are mapped, so an unmapped code takes up a place.
    A group is as long as the scorer has languages.
    """
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("neg"), F.col("code").alias("code"))))
    top = scores.groupBy("row_key").agg(F.slice(ordered, 1, settings.top_k).alias("_top"))
    if settings.label_map:
        known = F.create_map(*[F.lit(x) for pair in settings.label_map.items() for x in pair])
    else:
        known = F.create_map().cast("map<string,string>")
    named = F.transform(
        F.col("_top"),
        lambda s: F.struct(F.try_element_at(known, s["code"]).alias("language"), (-s["neg"]).alias("score")),
    )
    return top.select("row_key", F.filter(named, lambda s: s["language"].isNotNull()).alias("ranked"))


def decide(rows: DataFrame, scores: DataFrame | None, settings: LanguageSettings) -> DataFrame:
    """Add ``reason`` (NULL = accepted), ``languages``, ``language_label`` and ``confidence``.

    ``rows`` has ``row_key`` and ``text``. Ladder, in order: too short, cue, no scorer for
    the row, unsupported, mixed, low confidence, accept.
    """
    cleaned = rows.withColumn("_clean", clean_text("text"))
    cleaned = cleaned.withColumn("_early", early_reason(F.col("_clean"), settings)).drop("_clean")
    if scores is None:
        judged = cleaned.withColumn("ranked", F.lit(None).cast("array<struct<language:string,score:double>>"))
    else:
        judged = cleaned.join(collect_scores(scores, settings), "row_key", "left")
    ranked = F.col("ranked")
    known = text_array(settings.supported)
    strong = F.array_distinct(
        F.transform(
            F.filter(
                ranked,
                lambda s: (s["score"] >= settings.mixed_confidence_threshold) & F.array_contains(known, s["language"]),
            ),
            lambda s: s["language"],
        )
    )
    top = F.try_element_at(ranked, F.lit(1))
    reason = (
        F.when(F.col("_early").isNotNull(), F.col("_early"))
        .when(ranked.isNull(), F.lit("fasttext_model_unavailable"))
        .when(F.size(ranked) == 0, F.lit("unsupported_language"))
        .when(~F.array_contains(known, top["language"]), F.lit("unsupported_language"))
        .when(F.size(strong) > 1, F.lit("possible_mixed_language"))
        .when(top["score"] < settings.confidence_threshold, F.lit("low_confidence"))
    )
    judged = judged.withColumn("reason", reason)
    accepted = F.col("reason").isNull()
    languages = F.when(accepted, F.array(top["language"])).otherwise(F.array().cast("array<string>"))
    return judged.withColumns(
        {
            "languages": languages,
            "language_label": language_label(languages, settings.order),
            "confidence": F.when(accepted, top["score"]).otherwise(F.lit(0.0)),
        }
    ).drop("ranked", "_early")


def goes_to_batch(reason: Column, settings: LanguageSettings) -> Column:
    """Whether a fallback reason may be sent to the labeller."""
    wanted = [r.strip() for r in settings.batch_reasons if r.strip()]
    allowed = reason.isin(*wanted) if wanted else F.lit(False)
    if settings.batch_low_confidence:
        allowed = allowed | (reason == "low_confidence")
    return F.coalesce(allowed, F.lit(False))
