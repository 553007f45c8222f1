"""User-based collaborative filtering on the viewing fact.

* binary interactions: watched = minutes (rounded to 0.1) above zero;
* cosine similarity of binary rows, exact, through an inverted index with bounds (no item self-join);
* 20 nearest neighbours per user (ties by user id), zero-similarity users
  never enter (they would add nothing to any score);
* score of an unseen title = sum of the similarities of the neighbours who
  watched it; top n per user, ties by content id;
* evaluation: per user with 5+ titles, hide max(1, floor(20%)) titles chosen
  by md5(user|title) order, recommend from the remaining rows against
  everyone's full rows, and count hits in the top 5 and top 10.

Scores are sums of doubles; they are ranked after rounding to 9 decimals so
that summation order cannot reorder true ties.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.neighbours import nearest_users
from ..operators.scores import best_titles, packed_lists
from ..operators.similarity import block_similarity
from ..operators.stored import numbered, store, store_in_order
from ..operators.topk import top_k_per_key
from .eda import interactions_binary
from .warehouse import Warehouse

N_NEIGHBOURS = 20
N_RECS = 10
HOLDOUT_SHARE = 0.2
MIN_ITEMS = 5


def user_similarity(wh: Warehouse) -> DataFrame:
    b = interactions_binary(wh)
    s = block_similarity(b)
    return s.withColumn("similarity", F.round("similarity", 9))


def neighbours(left: DataFrame, right: DataFrame | None = None, k: int = N_NEIGHBOURS) -> DataFrame:
    return nearest_users(left, right, k).select(
        F.col("user_1").alias("user_id"), F.col("user_2").alias("neighbour_id"), "shared", "similarity", "neighbour_rank")


def similar_users_topk(wh: Warehouse) -> DataFrame:
    n = neighbours(interactions_binary(wh))
    return n.withColumn("similarity", F.round("similarity", 9))


def _score(nb: DataFrame, seen: DataFrame, catalogue_rows: DataFrame, n: int) -> DataFrame:
    """nb: (user_id, neighbour_id, similarity); seen: the user's own rows;
    catalogue_rows: the neighbours' rows (user_id, content_id).

    A neighbour's titles go to the user as one packed list of numbers, and so
    do the user's own; titles are counted where the user is, so that no (user,
    title) row is shuffled. The numbers are in the order of the ids."""
    ranges = max(2, int(nb.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    titles = store_in_order(catalogue_rows.select("content_id").distinct(), [F.col("content_id")], ranges)
    titles = store(numbered(titles, "title").select(F.col("content_id").alias("_cid"), "title"), "titles")
    kind = "int" if titles.count() < 1 << 31 else "long"
    # a row without a title is a title to recommend, but never one seen
    none = titles.where(F.col("_cid").isNull()).count()

    def lists(rows: DataFrame, name: str) -> DataFrame:
        named = rows.where(F.col("user_id").isNotNull()).join(titles, F.col("content_id").eqNullSafe(F.col("_cid")))
        sets = named.groupBy("user_id").agg(F.collect_set(F.col("title").cast(kind)).alias("titles"))
        return store(sets.mapInArrow(packed_lists, "user_id string, titles binary"), name)

    held = lists(catalogue_rows, "titles-held")
    own = (held if seen is catalogue_rows else lists(seen, "titles-seen")).withColumn("similarity", F.lit(None).cast("double"))
    rows = nb.join(held.withColumnRenamed("user_id", "neighbour_id"), "neighbour_id").select("user_id", "similarity", "titles")
    rows = rows.unionByName(own).repartition("user_id").sortWithinPartitions("user_id")
    best = rows.mapInArrow(best_titles(n, none), "user_id string, best array<struct<title: bigint, score: double, n: bigint>>")
    order = F.transform("best", lambda x: F.struct((-F.round(x["score"], 9)).alias("neg"), x["title"].alias("title"), x["n"].alias("n")))
    top = best.select("user_id", F.posexplode(F.slice(F.array_sort(order), 1, n)).alias("_at", "b")).select(
        "user_id", F.col("b.title").alias("title"), (-F.col("b.neg")).alias("recommendation_score"),
        F.col("b.n").alias("neighbours_watched"), (F.col("_at") + 1).alias("rec_rank"))
    return top.join(titles, "title").withColumnRenamed("_cid", "content_id").drop("title")


def _details(wh: Warehouse, recs: DataFrame) -> DataFrame:
    d = wh.mart_content_performance.select("content_id", "title", "content_type", "genre",
                                           "completion_rate", "total_views")
    return recs.join(d, "content_id", "left").select(
        "user_id", "rec_rank", "content_id", F.round("recommendation_score", 6).alias("recommendation_score"),
        "neighbours_watched", F.substring("title", 1, 25).alias("title_short"), "title",
        "content_type", "genre", "completion_rate", "total_views")


def recommend_topn(wh: Warehouse, n: int = N_RECS) -> DataFrame:
    wh.keep_pairs()
    b = interactions_binary(wh)
    return _details(wh, _score(neighbours(b), b, b, n))


def first_user(wh: Warehouse) -> DataFrame:
    """The engagement mart's first user (smallest user id)."""
    # the mart has a row for every row of dim_users, and its ids
    return wh.dim_users.agg(F.min("user_id").alias("user_id"))


def recommend_one(wh: Warehouse, user_id: str | None = None, n: int = N_RECS,
                  n_similar_users: int = N_NEIGHBOURS) -> DataFrame:
    """Recommendations for one user through an inverted-index join: the
    user's titles meet the rows of those titles only (linear, no all-pairs).
    An unknown user gives zero rows."""
    b = store(interactions_binary(wh), "interactions")
    target = (wh.spark.createDataFrame([(user_id,)], "user_id string") if user_id
              else first_user(wh))
    mine = b.join(target, "user_id")
    n_mine = mine.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_1"))
    counts = b.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_2"))
    shared = (mine.join(b.withColumnRenamed("user_id", "neighbour_id"), "content_id")
              .filter(F.col("neighbour_id") != F.col("user_id"))
              .groupBy("user_id", "neighbour_id").agg(F.count(F.lit(1)).alias("shared")))
    sims = (shared.join(n_mine, "user_id").join(counts.withColumnRenamed("user_id", "neighbour_id"),
                                                "neighbour_id")
            .withColumn("similarity", F.col("shared") / F.sqrt((F.col("n_1") * F.col("n_2")).cast("double"))))
    nb = top_k_per_key(sims, "user_id", [F.col("similarity").desc(), F.col("neighbour_id")],
                       n_similar_users, rank_col="neighbour_rank")
    nb = store(nb.select("user_id", "neighbour_id", "similarity"), "neighbours")        # n_similar_users rows
    theirs = b.join(nb.select(F.col("neighbour_id").alias("user_id")), "user_id", "left_semi")
    return _details(wh, _score(nb, mine, theirs, n))


def rec_holdout(wh: Warehouse) -> DataFrame:
    """Per user with 5+ titles: hide max(1, floor(0.2 n)) titles, the first by
    md5(user|title); other users keep every title in training."""
    b = interactions_binary(wh)
    own = Window.partitionBy("user_id")
    w = own.orderBy(F.md5(F.concat_ws("|", "user_id", "content_id")), "content_id")
    r = b.where(F.col("user_id").isNotNull()).withColumn("n_items", F.count(F.lit(1)).over(own)).withColumn(
        "_pos", F.row_number().over(w))
    hide = F.greatest(F.lit(1), F.floor(F.col("n_items") * F.lit(2) / F.lit(10)))
    return r.select("user_id", "content_id", "n_items",
                    ((F.col("n_items") >= MIN_ITEMS) & (F.col("_pos") <= hide)).alias("is_holdout"))


def rec_hit_rate(wh: Warehouse) -> DataFrame:
    """Hit rate at 5 and 10 over every user with 5+ titles."""
    h = store(rec_holdout(wh), "holdout")
    full = h.select("user_id", "content_id")
    evalu = h.filter(F.col("n_items") >= MIN_ITEMS)
    train = evalu.filter(~F.col("is_holdout")).select("user_id", "content_id")
    held = evalu.filter(F.col("is_holdout")).select("user_id", "content_id")
    nb = neighbours(train, full).select("user_id", "neighbour_id", "similarity")
    recs = _score(nb, train, full, N_RECS)
    hits = recs.join(held, ["user_id", "content_id"]).groupBy("user_id").agg(
        F.min("rec_rank").alias("first_hit"))
    users = evalu.select("user_id").distinct()
    j = users.join(hits, "user_id", "left")
    return j.agg(F.count(F.lit(1)).alias("users_evaluated"),
                 F.count_if(F.col("first_hit") <= 5).alias("hits_at_5"),
                 F.count_if(F.col("first_hit") <= 10).alias("hits_at_10")) \
        .withColumn("hit_rate_5", F.col("hits_at_5") / F.col("users_evaluated")) \
        .withColumn("hit_rate_10", F.col("hits_at_10") / F.col("users_evaluated"))


def genre_share(wh: Warehouse) -> DataFrame:
    """Genre shares of all recommendations against the catalogue."""
    recs = recommend_topn(wh)
    whole = Window.partitionBy()        # over the genre rows only
    r = recs.groupBy("genre").agg(F.count(F.lit(1)).alias("_r"))
    r = r.withColumn("_r", F.col("_r") / F.sum("_r").over(whole))
    c = wh.dim_content.groupBy("genre").agg(F.count(F.lit(1)).alias("_c"))
    c = c.withColumn("_c", F.col("_c") / F.sum("_c").over(whole))
    return r.join(c, "genre", "full").select(
        "genre", F.coalesce(F.col("_r"), F.lit(0.0)).alias("recommended_share"),
        F.coalesce(F.col("_c"), F.lit(0.0)).alias("catalog_share"))


def mean_similarity(wh: Warehouse) -> DataFrame:
    """Mean cosine similarity over all U (U - 1) / 2 user pairs, zero pairs
    included, without making a pair: a pair's similarity is the sum of
    w_1 * w_2 over its common titles, w = 1 / sqrt(titles of the user), so the
    pairs of one title add up to ((sum w)^2 - sum w^2) / 2."""
    b = interactions_binary(wh).select("user_id", "content_id")
    sizes = b.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    titles = b.join(sizes, "user_id").groupBy("content_id").agg(
        F.sum(1 / F.sqrt("_n")).alias("_w"), F.sum(1 / F.col("_n")).alias("_w2"))
    users = sizes.agg(F.count(F.lit(1))).scalar()
    return titles.agg(F.sum((F.col("_w") * F.col("_w") - F.col("_w2")) / 2).alias("_s")).select(
        users.alias("n_users"), F.round(F.col("_s") / (users * (users - 1) / 2), 6).alias("mean_similarity"))
