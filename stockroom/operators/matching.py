"""Free-text and code matching against the catalog.

Token matching is a blocked join, never a cross product: every name is exploded into its
distinct tokens, and a query token can only hit a catalog token that *starts* with it, so
both sides are joined on the first three characters (tokens shorter than three characters
can only match exactly and are joined on the whole token). That join runs over the two
vocabularies; names meet through their rarest tokens only, and hits are counted on the
token arrays of the pairs that met - all in the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import together, write_table


def tokens(df: DataFrame, id_cols: list[str], text_col: str) -> DataFrame:
    """Distinct whitespace tokens of a normalised text column: id_cols..., tok."""
    return (df.select(*id_cols, F.explode(F.array_distinct(F.split(F.col(text_col), " "))).alias("tok"))
              .filter(F.col("tok") != ""))


SALTS = 16  # sub-blocks per token block on the candidate side


def _block(t: DataFrame, col: str) -> DataFrame:
    return t.withColumn("blk", F.when(F.length(col) >= 3, F.substring(col, 1, 3)).otherwise(F.col(col)))


def _matches(q: DataFrame, c: DataFrame) -> DataFrame:
    """Query-token x candidate-token pairs that hit: equal, or the query token (>= 3
    characters) is a proper prefix. ``q`` has ``qt``, ``c`` has ``ct``. A short query token
    can only hit an equal token (an equi-join on the token); a long one can only hit tokens
    sharing its first three characters (an equi-join on that block, then the residual
    prefix test) - never a cross product."""
    short = q.filter(F.length("qt") < 3).join(c, F.col("qt") == F.col("ct"))
    # a common 3-character block (every "blu..." token) is a hot key: the candidate side is
    # spread over SALTS sub-blocks by a hash of the token row, and the (small) query side is
    # repeated once per sub-block, so one block never lands in a single task
    lq = (_block(q.filter(F.length("qt") >= 3), "qt")
          .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    lc = (_block(c.filter(F.length("ct") >= 3), "ct")
          .withColumn("salt", F.pmod(F.xxhash64(*c.columns), F.lit(SALTS)).cast("int")))
    long = lq.join(lc, ["blk", "salt"]).filter(
        (F.col("qt") == F.col("ct")) | ((F.length("qt") < F.length("ct")) & F.col("ct").startswith(F.col("qt"))))
    return short.unionByName(long.drop("blk", "salt"))


def _vocabulary(q_tokens: DataFrame, c_tokens: DataFrame) -> DataFrame:
    """(qt, ct, n): which candidate tokens each query token hits, with the number of candidates that
    hold them. Runs over the two distinct vocabularies, not over names."""
    words = c_tokens.groupBy(F.col("tok").alias("ct")).agg(F.count("*").alias("n"))
    return _matches(q_tokens.select(F.col("tok").alias("qt")).distinct(), words)


#: A query token that hits more candidates than this is common.
RARE_REACH = 200
#: Sets of more common tokens than this are compared pair by pair instead of by their subsets.
SUBSET_TOKENS = 10


def _hits(toks, words):
    """How many query tokens hit a candidate word: equal, or (3 characters and more) its beginning."""
    return F.size(F.filter(toks, lambda t: F.exists(words, lambda w: (w == t) | ((F.length(t) >= 3) & w.startswith(t)))))


def _subsets(tokens_col: str):
    """The non-empty subsets of a sorted token array, each as one text with its size."""
    return F.expr(f"transform(sequence(1, cast(pow(2, size({tokens_col})) as int) - 1), m -> "
                  f"filter({tokens_col}, (x, i) -> (shiftright(m, i) & 1) = 1))")


def split_queries(q_tokens: DataFrame, vocabulary: DataFrame, q_id: list[str]) -> DataFrame:
    """Per query its distinct tokens, the rare ones (looked up one by one) and the common ones (looked
    up as sets; a query with very many counts all of its tokens as rare)."""
    reach = vocabulary.groupBy(F.col("qt").alias("tok")).agg(F.sum("n").alias("reach"))
    t = q_tokens.join(reach, "tok", "left").groupBy(*q_id).agg(
        F.array_sort(F.collect_set("tok")).alias("toks"),
        F.array_sort(F.collect_set(F.when(F.col("reach") <= RARE_REACH, F.col("tok")))).alias("rare"),
        F.array_sort(F.collect_set(F.when(F.col("reach") > RARE_REACH, F.col("tok")))).alias("common"))
    many = F.size("common") > SUBSET_TOKENS
    return (t.withColumn("rare", F.when(many, F.concat("rare", "common")).otherwise(F.col("rare")))
             .withColumn("common", F.when(many, F.array().cast("array<string>")).otherwise(F.col("common"))))


def candidate_pairs(queries: DataFrame, common_sets: DataFrame, vocabulary: DataFrame, c_tokens: DataFrame, q_id: list[str],
                    c_id: str) -> DataFrame:
    """The (query, candidate) pairs that are compared one by one: those that share a rare token, and
    the candidates with very many common tokens. At most about RARE_REACH for a query token."""
    hit = vocabulary.select("qt", "ct").join(c_tokens.select(F.col("tok").alias("ct"), c_id), "ct")
    rare = queries.select(*q_id, F.explode("rare").alias("qt")).join(hit, "qt").select(*q_id, c_id)
    wide = common_sets.filter(F.size("common") > SUBSET_TOKENS).select(c_id, F.explode("common").alias("qt"))
    wide = queries.select(*q_id, F.explode("common").alias("qt")).join(wide, "qt").select(*q_id, c_id)
    return rare.unionByName(wide).distinct()


def best_match(q_tokens: DataFrame, c_tokens: DataFrame, q_id: list[str], c_id: str, c_rank: DataFrame | None,
               min_score: float | None = None) -> DataFrame:
    """Best candidate per query by score = hits / distinct query tokens; ties go to the candidate
    with the smallest ``ord`` in ``c_rank`` (c_id, ord), else the smallest id. Returns q_id..., c_id,
    score.

    A query's rare tokens give few candidates, which are verified on the token arrays. Candidates that
    share only common tokens with it are not paired: of each set of common tokens the candidate with the
    smallest ``ord`` that hits all of it is kept, and the query takes its largest subset that has one. A
    candidate that hits more of the query than that subset shares a rare token, so it is among the
    pairs. The work grows with the names and the queries, not with their product."""
    q_tokens, c_tokens = together(q_tokens.sparkSession, lambda: write_table(q_tokens, "match-query-tokens"),
                                  lambda: write_table(c_tokens.select(c_id, "tok"), "match-candidate-tokens"))
    vocabulary = write_table(_vocabulary(q_tokens, c_tokens), "match-vocabulary")
    queries = write_table(split_queries(q_tokens, vocabulary, q_id), "match-queries")
    order = (lambda df: df.withColumn("ord", F.col(c_id))) if c_rank is None else (lambda df: df.join(c_rank, c_id))
    best = F.min_by(F.struct(c_id, "hits"), F.struct((-F.col("hits")).alias("h"), F.col("ord").alias("o"))).alias("b")

    common = queries.select(F.explode("common").alias("qt")).distinct().join(vocabulary.select("qt", "ct"), "qt")
    sets = write_table(c_tokens.select(c_id, F.col("tok").alias("ct")).join(common, "ct")
                       .groupBy(c_id).agg(F.array_sort(F.collect_set("qt")).alias("common")), "match-common-sets")
    pairs = candidate_pairs(queries, sets, vocabulary, c_tokens, q_id, c_id)
    names = c_tokens.groupBy(c_id).agg(F.collect_set("tok").alias("words"))
    paired = (order(pairs).join(names, c_id).join(queries.select(*q_id, "toks"), q_id)
              .withColumn("hits", _hits(F.col("toks"), F.col("words"))).select(*q_id, c_id, "ord", "hits"))

    first = (order(sets.filter(F.size("common") <= SUBSET_TOKENS)).groupBy("common").agg(F.min(F.struct("ord", c_id)).alias("f"))
             .select(F.explode(_subsets("common")).alias("part"), "f").groupBy("part").agg(F.min("f").alias("f")))
    asked = queries.filter(F.size("common") > 0).select("common").distinct()
    by_set = (asked.select("common", F.explode(_subsets("common")).alias("part")).join(first, "part")
              .groupBy("common").agg(F.min(F.struct((-F.size("part")).alias("h"), F.col("f.ord").alias("ord"), F.col(f"f.{c_id}").alias(c_id))).alias("b")))
    grouped = (queries.join(by_set, "common").select(*q_id, F.col(f"b.{c_id}").alias(c_id), F.col("b.ord").alias("ord"), (-F.col("b.h")).alias("hits")))

    out = paired.unionByName(grouped).groupBy(*q_id).agg(best).join(queries.select(*q_id, F.size("toks").alias("n")), q_id)
    out = out.select(*q_id, F.col(f"b.{c_id}").alias(c_id), (F.col("b.hits") / F.col("n")).alias("score"))
    return out if min_score is None else out.filter(F.col("score") >= min_score)


def containment(q_tokens: DataFrame, c_tokens: DataFrame, q_id: list[str], c_id: str) -> DataFrame:
    """Candidates whose token set contains every query token (equi-join on the token,
    then hits == query size)."""
    n = q_tokens.groupBy(*q_id).agg(F.count("*").alias("n_q"))
    j = q_tokens.join(c_tokens.select(c_id, "tok"), "tok").groupBy(*q_id, c_id).agg(F.count("*").alias("hits"))
    return j.join(n, q_id).filter(F.col("hits") == F.col("n_q")).select(*q_id, c_id)
