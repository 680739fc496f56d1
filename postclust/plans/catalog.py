"""Named queries over the driver tables, one per operator group.

Every query reads ``orders`` and ``lineitem`` (and ``documents`` for the
bad-record feed) through the posting mapping of ``sources.tables``, so its work
grows with the tables. Each callable takes ``(spark, sf_dir)`` and returns a
DataFrame whose column names match the oracle SQL in ``plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postclust.functions.geometry import total_shift
from postclust.operators import joins, postings as post
from postclust.operators.kmeans import assign, centers_frame, converged, kmeans_step, trace_frame
from postclust.operators.sampling import initial_centers, sample_fraction, sample_sizes, seed_sample
from postclust.operators.scoring import score_questions
from postclust.operators.summary import cluster_lang_stats
from postclust.operators.vectors import vectorize, weigh_points, with_labels
from postclust.params import Params
from postclust.plans.analysis import fit_vectors, run_analysis, seed_and_points
from postclust.session import cut_lineage, scratch_folder
from postclust.sources.report import report_lines
from postclust.sources.stored import store_postings
from postclust.sources.tables import PRIORITY_LANGS, TABLE_PARAMS, postings_from_tables, read_table
from postclust.sources.text import parse_postings, quarantine, read_lines, render_lines, text_lines

# --- Fixed values: parameter sets of the registered queries ------------------
WIDE = TABLE_PARAMS                         # spread 50000: one language per cluster, W1 seed
NARROW = TABLE_PARAMS.replace(spread=100)   # spread 100: mixed clusters, W2 seed
UNKNOWN = TABLE_PARAMS.replace(langs=tuple(l for l in PRIORITY_LANGS if l != "3-MEDIUM"), kernels=12)
KNOWN_ONLY = UNKNOWN.replace(drop_unknown=True)  # unknown-language questions left out of the fit
CAPPED = NARROW.replace(max_iterations=5)         # stops before converging (needs about 40 steps)
FAR_CENTER = (1_000_000, 1_000_000)         # extra center no point is near (stays empty)
# -----------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def _postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings_from_tables(spark, sf_dir)


def _vectors(spark: SparkSession, sf_dir: str, params: Params) -> DataFrame:
    return vectorize(score_questions(_postings(spark, sf_dir)), params)


def posting_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a mixed text feed: the postings rendered as lines, followed by
    every line of every ``documents`` text (which are not postings)."""
    rendered = render_lines(_postings(spark, sf_dir))
    return rendered.unionByName(text_lines(read_table(spark, sf_dir, "documents"), "text"))


def q_parse_postings(spark, sf_dir):
    return parse_postings(render_lines(_postings(spark, sf_dir)), mode="failfast").postings


def q_text_postings(spark, sf_dir):
    """S1 + S2 over files: the postings are written as lines, scanned and parsed."""
    path = f"{scratch_folder(spark)}/lines-{uuid.uuid4().hex}"
    render_lines(_postings(spark, sf_dir)).write.text(path)
    return parse_postings(read_lines(spark, path), mode="failfast").postings


def q_quarantine(spark, sf_dir):
    """S3 in one pass over the mixed feed: the bad lines, read from what it wrote."""
    path = f"{scratch_folder(spark)}/parsed-{uuid.uuid4().hex}"
    return quarantine(posting_feed(spark, sf_dir), path).bad


def q_bad_records(spark, sf_dir):
    return parse_postings(posting_feed(spark, sf_dir), mode="quarantine").bad


def q_questions(spark, sf_dir):
    return post.questions(_postings(spark, sf_dir))


def q_answers(spark, sf_dir):
    return post.answers(_postings(spark, sf_dir))


def q_join_pairs(spark, sf_dir):
    return joins.join_pairs(_postings(spark, sf_dir))


def q_join_pairs_salted(spark, sf_dir):
    """J1 through explicit hot-key salting (the path taken without adaptive skew join)."""
    return joins.join_pairs(_postings(spark, sf_dir), salted=True)


def q_left_join_questions(spark, sf_dir):
    return joins.left_join_questions(_postings(spark, sf_dir))


def _pair_stats(pairs: DataFrame) -> DataFrame:
    score = F.col("answer_score")
    return pairs.groupBy("question_id").agg(
        F.count("*").alias("n_rows"), F.count("answer_id").alias("n_answers"), F.sum(score).alias("sum_score"),
        F.min(score).alias("least_score"), F.max(score).alias("best_score"), F.max("answer_id").alias("last_answer"),
        F.min("tags").alias("first_tag"), F.sum("question_score").alias("sum_question_score"))


def q_join_pairs_stats(spark, sf_dir):
    """J1, its pairs folded per question."""
    return _pair_stats(joins.join_pairs(_postings(spark, sf_dir)))


def q_left_join_stats(spark, sf_dir):
    """J2, its rows folded per question."""
    return _pair_stats(joins.left_join_questions(_postings(spark, sf_dir)))


def q_stored_left_pairs(spark, sf_dir):
    """J1 and J2 over postings stored by question."""
    return _pair_stats(store_postings(_postings(spark, sf_dir)).left_pairs())


def q_stored_scores(spark, sf_dir):
    """A2 and A3 over postings stored by question."""
    return store_postings(_postings(spark, sf_dir)).scored()


def q_grouped_counts(spark, sf_dir):
    return joins.grouped_counts(_postings(spark, sf_dir))


def q_scored_questions(spark, sf_dir):
    return score_questions(_postings(spark, sf_dir))


def q_vectors(spark, sf_dir):
    return _vectors(spark, sf_dir, WIDE)


def q_vectors_unknown(spark, sf_dir):
    return _vectors(spark, sf_dir, UNKNOWN)


def q_lang_labels(spark, sf_dir):
    return with_labels(_vectors(spark, sf_dir, UNKNOWN), UNKNOWN).select("question_id", "x", "lang_index", "lang")


def q_weighted_points(spark, sf_dir):
    return weigh_points(_vectors(spark, sf_dir, WIDE))


def q_sample_per_language(spark, sf_dir):
    return seed_sample(_vectors(spark, sf_dir, WIDE), WIDE)


def q_sample_global(spark, sf_dir):
    return seed_sample(_vectors(spark, sf_dir, NARROW), NARROW)


def q_sample_bernoulli(spark, sf_dir):
    """10 % of the vectors, each at most once."""
    return sample_fraction(_vectors(spark, sf_dir, WIDE), 0.1, with_replacement=False, seed=0)


def q_sample_poisson(spark, sf_dir):
    """W3 with replacement: a vector may be drawn several times."""
    return sample_fraction(_vectors(spark, sf_dir, WIDE), 0.5, with_replacement=True, seed=0)


def q_sample_sizes(spark, sf_dir):
    """The seed sample's vectors per language against the parameters."""
    return sample_sizes(seed_sample(_vectors(spark, sf_dir, WIDE), WIDE), WIDE)


def q_assign(spark, sf_dir):
    vectors = cut_lineage(_vectors(spark, sf_dir, WIDE))  # read by the seed sample and the assignment
    return assign(vectors, initial_centers(vectors, WIDE)).select("question_id", "x", "y", "cid")


def _step_centers(spark, sf_dir):
    init, points = seed_and_points(_vectors(spark, sf_dir, WIDE), WIDE)
    start = init + [(len(init), *FAR_CENTER)]
    moved = kmeans_step(points, start)
    points.unpersist()
    return start, moved


def q_kmeans_step(spark, sf_dir):
    _, moved = _step_centers(spark, sf_dir)
    return centers_frame(spark, moved)


def q_center_shift(spark, sf_dir):
    start, moved = _step_centers(spark, sf_dir)
    shift = total_shift([(x, y) for _, x, y in start], [(x, y) for _, x, y in moved])
    return spark.createDataFrame([(shift, converged(shift, WIDE))], "total_shift DOUBLE, converged BOOLEAN")


def _fitted(spark, sf_dir, params):
    points, _, result = fit_vectors(_vectors(spark, sf_dir, params), params)
    return points, result


def _fit_result(spark, sf_dir, params):
    """A fit of which only the centers or the trace are wanted."""
    points, result = _fitted(spark, sf_dir, params)
    points.unpersist()
    return result


def q_kmeans_fit_wide(spark, sf_dir):
    result = _fit_result(spark, sf_dir, WIDE)
    return centers_frame(spark, result.centers)


def q_kmeans_fit_narrow(spark, sf_dir):
    result = _fit_result(spark, sf_dir, NARROW)
    return centers_frame(spark, result.centers)


def q_kmeans_trace_capped(spark, sf_dir):
    result = _fit_result(spark, sf_dir, CAPPED)
    return trace_frame(spark, result)


def q_kmeans_trace(spark, sf_dir):
    result = _fit_result(spark, sf_dir, WIDE)
    return trace_frame(spark, result)


def q_cluster_lang_counts(spark, sf_dir):
    points, result = _fitted(spark, sf_dir, NARROW)
    return cluster_lang_stats(points, result.centers)


def q_cluster_summary(spark, sf_dir):
    return run_analysis(_postings(spark, sf_dir), WIDE).summary


def q_cluster_summary_narrow(spark, sf_dir):
    return run_analysis(_postings(spark, sf_dir), NARROW).summary


def q_cluster_summary_known(spark, sf_dir):
    return run_analysis(_postings(spark, sf_dir), KNOWN_ONLY).summary


def q_report(spark, sf_dir):
    return report_lines(run_analysis(_postings(spark, sf_dir), NARROW).summary)


QUERIES: dict[str, Query] = {
    "q_parse_postings": q_parse_postings,
    "q_text_postings": q_text_postings,
    "q_bad_records": q_bad_records,
    "q_quarantine": q_quarantine,
    "q_questions": q_questions,
    "q_answers": q_answers,
    "q_join_pairs": q_join_pairs,
    "q_join_pairs_salted": q_join_pairs_salted,
    "q_left_join_questions": q_left_join_questions,
    "q_join_pairs_stats": q_join_pairs_stats,
    "q_left_join_stats": q_left_join_stats,
    "q_stored_left_pairs": q_stored_left_pairs,
    "q_stored_scores": q_stored_scores,
    "q_grouped_counts": q_grouped_counts,
    "q_scored_questions": q_scored_questions,
    "q_vectors": q_vectors,
    "q_vectors_unknown": q_vectors_unknown,
    "q_lang_labels": q_lang_labels,
    "q_weighted_points": q_weighted_points,
    "q_sample_per_language": q_sample_per_language,
    "q_sample_global": q_sample_global,
    "q_sample_bernoulli": q_sample_bernoulli,
    "q_sample_poisson": q_sample_poisson,
    "q_sample_sizes": q_sample_sizes,
    "q_assign": q_assign,
    "q_kmeans_step": q_kmeans_step,
    "q_center_shift": q_center_shift,
    "q_kmeans_fit_wide": q_kmeans_fit_wide,
    "q_kmeans_fit_narrow": q_kmeans_fit_narrow,
    "q_kmeans_trace": q_kmeans_trace,
    "q_kmeans_trace_capped": q_kmeans_trace_capped,
    "q_cluster_lang_counts": q_cluster_lang_counts,
    "q_cluster_summary": q_cluster_summary,
    "q_cluster_summary_narrow": q_cluster_summary_narrow,
    "q_cluster_summary_known": q_cluster_summary_known,
    "q_report": q_report,
}
