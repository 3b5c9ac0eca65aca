"""All stages in order, each reading the master the one before it added to."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession

from talkloom.operators.langid import LanguageSettings
from talkloom.operators.terms import TermMatcher
from talkloom.plans.classification import Labeller, run_classification
from talkloom.plans.extraction import run_extraction
from talkloom.plans.language import Scorer, run_language
from talkloom.plans.preprocessing import run_preprocessing
from talkloom.plans.store import Store

STAGES = ("extraction", "preprocessing", "classification", "language_detection")


def run_all(
    spark: SparkSession,
    store: Store,
    run_id: str,
    run_ts: str,
    matcher: TermMatcher,
    model: str,
    landed: DataFrame | None = None,
    comments: DataFrame | None = None,
    classifier: Labeller | None = None,
    scorer: Scorer | None = None,
    language_labeller: Labeller | None = None,
    settings: LanguageSettings | None = None,
    prices: DataFrame | None = None,
    stages: Collection[str] = STAGES,
    force: bool = False,
    limit: int | None = None,
) -> dict[str, DataFrame]:
    """Summary rows per stage that ran. ``limit`` does not touch extraction."""
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {', '.join(sorted(unknown))}")
    summaries = {}
    if "extraction" in stages and landed is not None:
        summaries["extraction"] = run_extraction(spark, store, run_id, run_ts, landed, comments, force=force)
    if "preprocessing" in stages:
        summaries["preprocessing"] = run_preprocessing(spark, store, run_id, run_ts, force=force, limit=limit)
    if "classification" in stages:
        summaries["classification"] = run_classification(
            spark, store, run_id, run_ts, matcher, model, labeller=classifier, force=force, limit=limit, prices=prices
        )
    if "language_detection" in stages:
        summaries["language_detection"] = run_language(
            spark,
            store,
            run_id,
            run_ts,
            model,
            scorer=scorer,
            labeller=language_labeller,
            settings=settings,
            force=force,
            limit=limit,
            prices=prices,
        )
    return summaries
