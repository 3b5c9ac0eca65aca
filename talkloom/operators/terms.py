"""Term dictionaries: group -> language -> terms, matched against texts."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from talkloom.functions.text import match_form
from talkloom.schemas import (
    NO_VALID_TERMS,
    WITH_AI_AND_HEALTH_TERMS,
    WITH_AI_TERM_ONLY,
    WITH_HEALTH_TERM_ONLY,
)

# Python's \w for text: letters, numbers and underscore of any script.
WORD = r"\p{L}\p{N}_"
MAX_DICTIONARY_TERMS = 100_000
TERM_SCHEMA = "group string, language string, term string"


def terms_table(spark: SparkSession, groups: Mapping) -> DataFrame:
    """(group, language, term) from a nested mapping; a plain list has no language."""
    rows = [
        (group, language, term.strip())
        for group, nested in groups.items()
        for language, terms in _by_language(nested)
        for term in terms
    ]
    return spark.createDataFrame(rows, TERM_SCHEMA)


def _by_language(nested, path: str = ""):
    """Walk any depth of mappings and lists; blanks vanish, other scalars become text."""
    if isinstance(nested, Mapping):
        for name, inner in nested.items():
            yield from _by_language(inner, f"{path}/{name}" if path else str(name))
    elif isinstance(nested, (list, tuple)):
        for inner in nested:
            yield from _by_language(inner, path)
    elif nested is not None and nested != "":
        yield path, [str(nested)]


def read_dictionary(path: str) -> dict:
    """A dictionary file (JSON, or YAML where the parser is installed) as a mapping."""
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".json"):
            return json.load(handle)
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("YAML dictionaries need the yaml package; use JSON instead") from missing
        return yaml.safe_load(handle)


def distinct_terms(terms: DataFrame, group: str) -> DataFrame:
    """The term set of one group over all languages."""
    return terms.filter(F.col("group") == group).select("term").filter("term <> ''").distinct()


def collect_terms(terms: DataFrame, group: str) -> list[str]:
    """Terms of one group for building its pattern. A dictionary is configuration, so its
    size is checked rather than assumed."""
    rows = distinct_terms(terms, group).limit(MAX_DICTIONARY_TERMS + 1).collect()
    if len(rows) > MAX_DICTIONARY_TERMS:
        raise ValueError(f"dictionary group {group} exceeds {MAX_DICTIONARY_TERMS} terms")
    return sorted(r.term for r in rows)


def normalize_term(term: str, case_sensitive: bool = False) -> str:
    """A term in the form texts are matched in (driver side, one short string)."""
    text = " ".join(re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " ", unicodedata.normalize("NFKC", term)).split())
    return text if case_sensitive else text.casefold()


def group_pattern(
    terms: Iterable[str], case_sensitive: bool = False, word_boundaries: bool = True
) -> str | None:
    """One pattern that finds a text iff any term of the group matches it.

    ``*`` stands for any run of word characters and hyphens. Terms share their
    prefixes in the pattern, so a position of the text is compared with one branch per
    next character instead of with every term. Only existence is asked for, hence a
    trailing ``*`` needs nothing after its prefix.
    """
    tree: dict = {}
    inner: list[str] = []
    for term in sorted({normalize_term(t, case_sensitive) for t in terms} - {""}):
        stem = term.rstrip("*")
        open_end = stem != term or not word_boundaries
        if not stem or "*" in stem:
            pieces = [re.escape(p) for p in term.split("*")]
            inner.append(f"[{WORD}-]*".join(pieces) + (f"(?![{WORD}])" if word_boundaries else ""))
            continue
        _plant(tree, stem, open_end)
    branches = ([_tree_pattern(tree)] if tree else []) + inner
    if not branches:
        return None
    start = f"(?<![{WORD}])" if word_boundaries else ""
    return start + "(?:" + "|".join(branches) + ")"


def _plant(tree: dict, stem: str, open_end: bool) -> None:
    node = tree
    for char in stem:
        node = node.setdefault(char, {})
    node["open" if open_end else "closed"] = True


def _tree_pattern(node: dict) -> str:
    if node.get("open"):
        return ""
    branches = [re.escape(c) + _tree_pattern(child) for c, child in node.items() if len(c) == 1]
    if node.get("closed"):
        branches.append(f"(?![{WORD}])")
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"


@dataclass(frozen=True)
class TermMatcher:
    """Compiled patterns of the two groups."""

    ai_pattern: str | None
    health_pattern: str | None
    case_sensitive: bool = False

    @classmethod
    def build(
        cls,
        ai_terms: Iterable[str],
        health_terms: Iterable[str],
        case_sensitive: bool = False,
        word_boundaries: bool = True,
    ) -> TermMatcher:
        return cls(
            group_pattern(ai_terms, case_sensitive, word_boundaries),
            group_pattern(health_terms, case_sensitive, word_boundaries),
            case_sensitive,
        )

    @classmethod
    def from_table(
        cls,
        terms: DataFrame,
        ai_group: str = "ai_terms",
        health_group: str = "health_terms",
        case_sensitive: bool = False,
        word_boundaries: bool = True,
    ) -> TermMatcher:
        return cls.build(
            collect_terms(terms, ai_group), collect_terms(terms, health_group), case_sensitive, word_boundaries
        )


def has_match(matchable: Column, pattern: str | None) -> Column:
    if pattern is None:
        return F.lit(False)
    return F.coalesce(matchable.rlike(pattern), F.lit(False))


def available_terms(has_ai: Column, has_health: Column) -> Column:
    return (
        F.when(has_ai & has_health, F.lit(WITH_AI_AND_HEALTH_TERMS))
        .when(has_ai, F.lit(WITH_AI_TERM_ONLY))
        .when(has_health, F.lit(WITH_HEALTH_TERM_ONLY))
        .otherwise(F.lit(NO_VALID_TERMS))
    )


def with_available_terms(
    df: DataFrame, matcher: TermMatcher, text: str = "text", only_if: Column | None = None
) -> DataFrame:
    """Add ``available_terms``. Rows outside ``only_if`` are not scanned (NULL)."""
    matchable = match_form(text, matcher.case_sensitive)
    if only_if is not None:
        matchable = F.when(only_if, matchable)
    matched = df.withColumn("_match", matchable)
    found = matched.select(
        "*",
        has_match(F.col("_match"), matcher.ai_pattern).alias("_ai"),
        has_match(F.col("_match"), matcher.health_pattern).alias("_health"),
    )
    label = available_terms(F.col("_ai"), F.col("_health"))
    return found.withColumn("available_terms", F.when(F.col("_match").isNotNull(), label)).drop(
        "_match", "_ai", "_health"
    )


# ---- which terms hit, not only whether one does ----------------------------

_REGULAR_TERM = re.compile(r"\w+(?:[^\w*]+\w+)*\*?")


def term_hits(df: DataFrame, key: str, terms: DataFrame, text: str = "text") -> DataFrame:
    """(group, term, key): every dictionary term that occurs in each text, once per text.

    A text becomes its word phrases, up to the longest term; phrases whose first word no
    term starts with are dropped before the explode, and the rest meet the dictionary in an equi-join. The text
    itself is never copied per phrase. Terms that are not plain word sequences are tested
    one by one.
    """
    spark = df.sparkSession
    listed = terms.select("group", "term").distinct().limit(MAX_DICTIONARY_TERMS + 1).collect()
    if len(listed) > MAX_DICTIONARY_TERMS:
        raise ValueError(f"dictionary exceeds {MAX_DICTIONARY_TERMS} terms")
    lookup, odd = [], []
    for row in listed:
        term = normalize_term(row.term)
        if _REGULAR_TERM.fullmatch(term):
            lookup.append((row.group, row.term, term.rstrip("*"), term.endswith("*")))
        elif term:
            odd.append((row.group, row.term, group_pattern([term])))
    matched = df.select(F.col(key).alias("_key"), match_form(text).alias("_match"))
    parts = []
    if lookup:
        parts.append(_phrase_hits(spark, matched, lookup))
    if odd:
        tests = F.array(
            *[F.when(has_match(F.col("_match"), p), F.struct(F.lit(g).alias("group"), F.lit(t).alias("term"))) for g, t, p in odd]
        )
        hits = matched.select("_key", F.explode(F.array_compact(tests)).alias("h"))
        parts.append(hits.select("h.group", "h.term", "_key"))
    if not parts:
        return df.select(F.lit("").alias("group"), F.lit("").alias("term"), key).limit(0)
    union = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return union.withColumnRenamed("_key", key)


def _phrase_hits(spark: SparkSession, matched: DataFrame, lookup: list[tuple]) -> DataFrame:
    words = {stem: re.findall(r"\w+", stem) for _, _, stem, _ in lookup}
    # A longer term is reached through its whole first word, a one-word term through itself.
    heads: dict = {}
    for _, _, stem, is_open in lookup:
        _plant(heads, words[stem][0], is_open and len(words[stem]) == 1)
    head = _tree_pattern(heads)
    # The words of a phrase and the characters its last one is cut to (0: whole). As data and not as an
    # expression each, so that the generated code stays small enough to be compiled, whatever the dictionary.
    shapes = sorted({(len(words[s]), len(words[s][-1]) if o else 0) for _, _, s, o in lookup})

    if max(len(w) for w in words.values()) == 1:
        # Where no term has a second word, a text is its set of words. A plain explode would let the
        # optimizer ask for the size of the list first, and make the list twice.
        listed = F.array_distinct(F.regexp_extract_all("_match", F.lit(f"(?<![{WORD}])(?={head})[{WORD}]+"), F.lit(0)))
        at = matched.select("_key", F.explode_outer(listed).alias("word")).filter("word is not null")
        at = at.withColumns({"w": F.array("word"), "p": F.lit(0)})
    else:
        # Words and the separators between them alternate; p walks over the words.
        pieces = matched.select(
            "_key", F.regexp_extract_all("_match", F.lit(f"[{WORD}]+|[^{WORD}]+"), F.lit(0)).alias("w")
        ).withColumn("_first", F.when(F.get("w", F.lit(0)).rlike(f"^[{WORD}]"), 0).otherwise(1))
        at = pieces.select("_key", "w", "_first", F.posexplode("w").alias("p", "word")).filter("p % 2 = _first")
        at = at.filter(F.col("word").rlike(f"^{head}"))

    listed_shapes = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(c).alias("cut")) for n, c in shapes])
    shaped = at.select("_key", "w", "p", F.explode(listed_shapes).alias("s")).select("_key", "w", "p", "s.n", "s.cut")
    last = F.get("w", F.col("p") + 2 * (F.col("n") - 1))
    last = F.when(F.col("cut") == 0, last).when(F.char_length(last) >= F.col("cut"), F.substr(last, F.lit(1), F.col("cut")))
    run = F.array_join(F.slice("w", F.col("p") + 1, 2 * F.col("n") - 2), "")
    phrases = shaped.select("_key", F.concat(run, last).alias("stem"), (F.col("cut") > 0).alias("open"))
    table = spark.createDataFrame(lookup, "group string, term string, stem string, open boolean")
    # Bounded by MAX_DICTIONARY_TERMS short strings.
    return (
        phrases.filter("stem is not null")
        .join(F.broadcast(table), ["stem", "open"])
        .select("group", "term", "_key")
        .distinct()
    )
