"""End-to-end jobs over a folder of search-relevance CSV files.

    python -m relevo.plans.jobs JOB CSV_DIR OUT [--seed N] [--mode errorifexists|overwrite] [--n N]
        [--multi-line TABLE] [--input-bytes N] [--score train|test] [--coefficients PATH] [--lines]

JOB is one of: stage1_join (M1), wide_table (M2), term_classifier (M3), tfidf_linear (M4),
w2v_linear (M5), tf_score_linear (M6), ngram_linear (M7), corpus_linear (M8), corpus_forest (M9),
hit_forest (M10), hit_forest_tuned (M11). The folder holds train.csv, test.csv, attributes.csv and
product_descriptions.csv with a header (each job reads those it needs). Submissions are
(id, relevance) ordered by id, written as multi-part CSV with a header; the wide table is ordered by
product_uid and pair; M3-M6 write their scored rows. M4 and M5 score the test rows, or with ``--score
train`` the training rows, and write the linear model's coefficients and intercept to
``--coefficients``. ``--lines`` writes M3-M5 as printable lines.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo import models as M
from relevo import schemas as S
from relevo.operators import tables
from relevo.plans import flows
from relevo.session import apply_cluster_conf, apply_skew_conf, ensure_checkpoint_dir, remove_shared_tables
from relevo.sinks.csv import format_lines, write_csv, write_submission
from relevo.sources.csv import read_search_tables


def _pairs_with_holdout(t: dict[str, DataFrame]):
    """Train and test rows in one frame (test rows carry a NULL label) and the test predicate."""
    train = t["train"].withColumn("_is_test", F.lit(False))
    test = t["test"].withColumn(S.LABEL, F.lit(None).cast("double")).withColumn("_is_test", F.lit(True))
    both = tables.union_pairs(train, test)
    return both, F.col("_is_test")


def wide_table(spark: SparkSession, t: dict[str, DataFrame], seed: int) -> DataFrame:
    return flows.wide_training_table(t["train"], t["attributes"], t["product_descriptions"], keep_id=True)


def stage1_join(spark: SparkSession, t: dict[str, DataFrame], seed: int) -> DataFrame:
    as_text = {k: t[k].select(*[F.col(c).cast("string").alias(c) for c in t[k].columns]) for k in ("train", "product_descriptions")}
    return flows.stage1_join(spark, as_text["train"], as_text["product_descriptions"])


def _labelled(t: dict[str, DataFrame]) -> DataFrame:
    return tables.rename(t["train"].select(S.PRODUCT, S.TERM, S.LABEL), {S.LABEL: "label"})


def _scored(df: DataFrame) -> DataFrame:
    """The columns the pages print: identifiers and the prediction, ordered by product."""
    return df.select(*[c for c in (S.ID, S.PRODUCT, S.TERM, "label", "values", "prob", "prediction") if c in df.columns])


def term_classifier(spark: SparkSession, t: dict[str, DataFrame], seed: int) -> DataFrame:
    """Whole labels only, as an integer label column keeps them (``label_as='int'`` when reading)."""
    train = _labelled(t).where("label = floor(label)").withColumn("text", F.col(S.TERM)).withColumn("label", F.col("label").cast("int"))
    scored = flows.term_classifier(train, t["test"].withColumn("text", F.col(S.TERM)))[1]
    return _scored(scored.withColumn("prob", F.concat(F.lit("["), F.array_join(M.probabilities(), ","), F.lit("]"))))


def _term_model(spark: SparkSession, t: dict[str, DataFrame], fit: Callable, score: str, coefficients: str | None, mode: str) -> DataFrame:
    """Scored rows of a linear model on search terms; its coefficients as a table of their own."""
    train = _labelled(t)
    model, scored = fit(train, train if score == "train" else t["test"])
    if coefficients:
        linear = model.stages[-1] if isinstance(model, PipelineModel) else model
        names = [f"feature_{i}" for i in range(linear.numFeatures)]
        write_csv(M.coefficients(spark, linear, names), coefficients, mode=mode, single_file=True)
    return _scored(scored)


def tfidf_linear(spark: SparkSession, t: dict[str, DataFrame], seed: int, score: str = "test", coefficients: str | None = None,
                 mode: str = "errorifexists") -> DataFrame:
    return _term_model(spark, t, flows.tfidf_linear, score, coefficients, mode)


def w2v_linear(spark: SparkSession, t: dict[str, DataFrame], seed: int, score: str = "test", coefficients: str | None = None,
               mode: str = "errorifexists") -> DataFrame:
    return _term_model(spark, t, partial(flows.w2v_linear, seed=seed), score, coefficients, mode)


def tf_score_linear(spark: SparkSession, t: dict[str, DataFrame], seed: int) -> DataFrame:
    return _scored(flows.tf_score_linear(t["train"], t["product_descriptions"])[1])


def hit_forest(spark: SparkSession, t: dict[str, DataFrame], seed: int,
               stem_dictionary: str | None = None) -> DataFrame:
    pairs, is_test = _pairs_with_holdout(t)
    return flows.hit_rf_submission(pairs, t["product_descriptions"], is_test, seed=seed,
                                   stem_dictionary=stem_dictionary)


def hit_forest_tuned(spark: SparkSession, t: dict[str, DataFrame], seed: int,
                     stem_dictionary: str | None = None) -> DataFrame:
    pairs, is_test = _pairs_with_holdout(t)
    return flows.hit_tvs_submission(pairs, t["product_descriptions"], is_test, seed=seed,
                                    stem_dictionary=stem_dictionary)


def corpus_linear(spark: SparkSession, t: dict[str, DataFrame], seed: int) -> DataFrame:
    return flows.corpus_w2v_submission(spark, t["train"], t["test"], t["attributes"],
                                       t["product_descriptions"], seed=seed, learner="linear")


def corpus_forest(spark: SparkSession, t: dict[str, DataFrame], seed: int) -> DataFrame:
    return flows.corpus_w2v_submission(spark, t["train"], t["test"], t["attributes"],
                                       t["product_descriptions"], seed=seed, learner="forest")


def ngram_linear(spark: SparkSession, t: dict[str, DataFrame], seed: int, n: int = 1) -> DataFrame:
    return flows.ngram_w2v_submission(t["train"], t["test"], seed=seed, n=n)


JOBS: dict[str, Callable[..., DataFrame]] = {
    "stage1_join": stage1_join,
    "wide_table": wide_table,
    "term_classifier": term_classifier,
    "tfidf_linear": tfidf_linear,
    "w2v_linear": w2v_linear,
    "tf_score_linear": tf_score_linear,
    "ngram_linear": ngram_linear,
    "corpus_linear": corpus_linear,
    "corpus_forest": corpus_forest,
    "hit_forest": hit_forest,
    "hit_forest_tuned": hit_forest_tuned,
}
#: Jobs whose scored rows the pages print as lines.
_LINES = ("term_classifier", "tfidf_linear", "w2v_linear")
#: The tables each job reads.
_PAIRS, _TEXT = ("train", "test"), ("attributes", "product_descriptions")
NEEDS = {
    "stage1_join": ("train", "product_descriptions"), "wide_table": ("train", *_TEXT), "term_classifier": _PAIRS,
    "tfidf_linear": _PAIRS, "w2v_linear": _PAIRS, "tf_score_linear": ("train", "product_descriptions"), "ngram_linear": _PAIRS,
    "corpus_linear": (*_PAIRS, *_TEXT), "corpus_forest": (*_PAIRS, *_TEXT),
    "hit_forest": (*_PAIRS, "product_descriptions"), "hit_forest_tuned": (*_PAIRS, "product_descriptions"),
}


def run(spark: SparkSession, job: str, csv_dir: str, out: str, seed: int = 42,
        mode: str = "errorifexists", stem_dictionary: str | None = None, n: int = 1,
        multi_line: Sequence[str] = (), input_bytes: int | None = None, score: str = "test",
        coefficients: str | None = None, lines: bool = False) -> None:
    """Read the job's tables, run it, write the result."""
    ensure_checkpoint_dir(spark)
    apply_skew_conf(spark)
    apply_cluster_conf(spark, input_bytes)
    found = read_search_tables(spark, csv_dir, tables=NEEDS[job], multi_line=multi_line)
    extra: dict = {}
    if job in ("hit_forest", "hit_forest_tuned"):
        extra["stem_dictionary"] = stem_dictionary
    if job == "ngram_linear":
        extra["n"] = n
    if job in ("tfidf_linear", "w2v_linear"):
        extra.update(score=score, coefficients=coefficients, mode=mode)
    result = JOBS[job](spark, found, seed, **extra)
    if lines and job in _LINES:
        fmt = "(%d, %s) --> prob=%s, prediction=%f" if "prob" in result.columns else "(%d, %s) --> prediction=%f"
        cols = [S.PRODUCT, S.TERM, *(["prob"] if "prob" in result.columns else []), "prediction"]
        format_lines(result, fmt, *cols).write.mode(mode).text(out)
    elif job == "wide_table":
        write_csv(result, out, mode=mode, order_by=[S.PRODUCT, S.ID], leave_out=[S.ID])
    elif S.LABEL in result.columns and S.ID in result.columns:
        write_submission(result, out, mode=mode)
    else:
        write_csv(result, out, mode=mode)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("csv_dir")
    ap.add_argument("out")
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--mode", default="errorifexists")
    ap.add_argument("--stem-dictionary", default=None,
                    help="shared folder of a persistent (word, stem) table for the hit_forest jobs")
    ap.add_argument("--n", type=int, default=1, help="words of an n-gram (ngram_linear)")
    ap.add_argument("--multi-line", action="append", default=[], help="a table whose fields hold line breaks")
    ap.add_argument("--input-bytes", type=int, default=None, help="input volume, to size a cluster run")
    ap.add_argument("--score", choices=("test", "train"), default="test", help="rows that tfidf_linear and w2v_linear score")
    ap.add_argument("--coefficients", default=None, help="path for the coefficients of tfidf_linear and w2v_linear")
    ap.add_argument("--lines", action="store_true", help="write printable lines (term_classifier, tfidf_linear, w2v_linear)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"relevo-{args.job}").getOrCreate()
    try:
        run(spark, args.job, args.csv_dir, args.out, args.seed, args.mode, args.stem_dictionary, args.n,
            args.multi_line, args.input_bytes, args.score, args.coefficients, args.lines)
    finally:
        remove_shared_tables(spark)


if __name__ == "__main__":
    main()
