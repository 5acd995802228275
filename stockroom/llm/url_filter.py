"""URL filter: rules first, then the likelihood ratio of two character language models.

The models are smoothed variable-order Markov models (Witten-Bell interpolation of orders 0 to
``ORDER``; a context that was never seen leaves the next shorter one as it is) of the URLs that
rules allow and of those that rules block. A URL's score is the difference of the two log
likelihoods per character. Four fifths of the ruled URLs (by CRC-32 of the page id) are counted,
all of them; the fifth fold calibrates the threshold: the point where both classes, taken as
normal, are equally many deviations away. Everything is DataFrame expressions.

Counts of all contexts come from one table of distinct (ORDER + 1)-grams, so the joins and windows
run over distinct grams. A gram that every URL holds is a hot key of the last join only, which
Spark's adaptive execution splits.

Defined results: a null URL or one without ``://`` has an empty host and path and no rule; a URL
without characters scores 0; a class without URLs, in the counts or in the calibration, gives the
threshold 0; URLs are judged by their text, so repeated rows agree; an empty table gives an empty
result; extra columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import kept, table

ORDER = 4
ALPHABET = 256.0
PAD = "^" * ORDER
# Fixed values: (host, path, verdict).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(pages: DataFrame, rules=None) -> DataFrame:
    """page_id, url, host, path, rule, ruled (the rule's verdict), body (what the models read)."""
    url = F.coalesce("url", F.lit(""))
    base = pages.select(
        "page_id", url.alias("url"),
        F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"))
    longest = sorted(RULES if rules is None else rules, key=lambda r: -len(r[0] + r[1]))
    fits = [(((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p), h + p, v)
            for h, p, v in longest]
    pick = lambda i: F.coalesce(*[F.when(f[0], f[i]) for f in fits], F.lit(None).cast("string"))
    body = F.translate(F.regexp_replace(F.col("url"), r"(?s)^.*?://", ""), UPPER + "123456789", LOWER + "000000000")
    return base.select("*", pick(1).alias("rule"), pick(2).alias("ruled"), body.alias("body"))


def grams(body):
    """The (ORDER + 1)-grams of a text, one for each character, padded in front."""
    padded = F.concat(F.lit(PAD), body)
    return F.when(F.length(body) > 0, F.transform(
        F.sequence(F.lit(1), F.length(body)), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))).otherwise(F.array().cast("array<string>"))


def gram_ratio(counted: DataFrame) -> DataFrame:
    """For each distinct gram of ``counted`` (gram, allow, block: counts) the difference of its last
    character's log probabilities in the two models, built up from order 0 to ORDER."""
    lower = None
    for n in range(ORDER + 1):
        level = (counted.groupBy(F.substring("gram", ORDER + 1 - n, n + 1).alias("gram"))
                        .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")))
        context = Window.partitionBy(F.substring("gram", 1, n))
        level = level.select(
            "gram", "allow", "block",
            *[x for k in ("allow", "block") for x in (
                F.sum(k).over(context).alias(f"{k}_seen"), F.sum((F.col(k) > 0).cast("long")).over(context).alias(f"{k}_kinds"))])
        if lower is None:
            level = level.withColumns({"allow_low": F.lit(1.0 / ALPHABET), "block_low": F.lit(1.0 / ALPHABET)})
        else:
            level = (level.withColumn("suffix", F.substring("gram", 2, n))
                          .join(lower.select(F.col("gram").alias("suffix"), F.col("allow_p").alias("allow_low"),
                                             F.col("block_p").alias("block_low")), "suffix"))
        lower = level.select("gram", *[
            F.when(F.col(f"{k}_seen") > 0, (F.col(k) + F.col(f"{k}_kinds") * F.col(f"{k}_low")) / (F.col(f"{k}_seen") + F.col(f"{k}_kinds")))
             .otherwise(F.col(f"{k}_low")).alias(f"{k}_p") for k in ("allow", "block")])
    return lower.select("gram", (F.log("allow_p") - F.log("block_p")).alias("ratio"))


def judge(pages: DataFrame, rules=None) -> DataFrame:
    """One row for each row of ``pages`` (page_id, url): host, path, rule, verdict, score."""
    urls = kept(parsed(pages, rules).withColumn("fold", F.crc32(F.col("page_id").cast("string").cast("binary")) % 5)
                                    .withColumn("key", F.xxhash64("body")), "urls")
    texts = (urls.groupBy("key").agg(
        F.first("body").alias("body"),
        *[F.sum(((F.col("ruled") == k) & (F.col("fold") > 0)).cast("long")).alias(k) for k in ("allow", "block")]))
    pieces = texts.select("key", F.coalesce("allow", F.lit(0)).alias("allow"), F.coalesce("block", F.lit(0)).alias("block"),
                          F.explode(grams(F.col("body"))).alias("gram"))
    ratio = gram_ratio(pieces.groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")))
    scores = pieces.join(ratio, "gram").groupBy("key").agg(F.avg("ratio").alias("score"))
    scored = kept(urls.join(scores, "key", "left").withColumn("score", F.coalesce("score", F.lit(0.0))), "url-scores")
    held = scored.filter((F.col("fold") == 0) & F.col("ruled").isNotNull())
    stats = held.agg(*[f(F.when(F.col("ruled") == k, F.col("score"))).alias(f"{k}_{n}")
                       for k in ("allow", "block") for n, f in (("mean", F.avg), ("sd", F.stddev_pop))])
    seen = urls.agg(*[F.sum(((F.col("ruled") == k) & (F.col("fold") > 0)).cast("long")).alias(k) for k in ("allow", "block")])
    limit = threshold(stats.first(), seen.first())
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("score") >= limit, "allow").otherwise("block")).alias("verdict"), "score")


def threshold(stats, seen) -> float:
    if not seen["allow"] or not seen["block"] or stats["allow_mean"] is None or stats["block_mean"] is None:
        return 0.0
    spread = stats["allow_sd"] + stats["block_sd"]
    if spread == 0:
        return (stats["allow_mean"] + stats["block_mean"]) / 2
    return (stats["allow_mean"] * stats["block_sd"] + stats["block_mean"] * stats["allow_sd"]) / spread


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _level(n: int) -> str:
    low = ("1.0 / 256" if n == 0 else "l.{k}_p")
    parts = []
    for k in ("allow", "block"):
        lo = low.format(k=k)
        parts.append(f"CASE WHEN {k}_seen > 0 THEN ({k} + {k}_kinds * ({lo})::DOUBLE) / ({k}_seen + {k}_kinds) ELSE ({lo})::DOUBLE END AS {k}_p")
    join = "" if n == 0 else f"JOIN p{n - 1} l ON l.gram = substr(s.gram, 2)"
    return f"""
c{n} AS (SELECT substr(gram, {ORDER + 1 - n}) AS gram, sum(allow) AS allow, sum(block) AS block FROM counted GROUP BY 1),
s{n} AS (SELECT *, sum(allow) OVER w AS allow_seen, sum((allow > 0)::INT) OVER w AS allow_kinds,
         sum(block) OVER w AS block_seen, sum((block > 0)::INT) OVER w AS block_kinds
         FROM c{n} WINDOW w AS (PARTITION BY substr(gram, 1, {n}))),
p{n} AS (SELECT s.gram, {", ".join(parts)} FROM s{n} s {join}),"""


def _rule(i: int) -> str:
    cases = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, v)[i]}'"
             for h, p, v in sorted(RULES, key=lambda r: -len(r[0] + r[1]))]
    return "CASE " + " ".join(cases) + " END"


ORACLE = r"""
WITH parsed AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'UPPER', 'LOWER') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
ruled AS (
  SELECT *, RULE AS rule, VERDICT AS ruled, FOLD AS fold,
         translate(regexp_replace(url, '(?s)^.*?://', ''), 'UPPER123456789', 'LOWER000000000') AS body FROM parsed),
texts AS (
  SELECT body, sum((ruled = 'allow' AND fold > 0)::INT) AS allow, sum((ruled = 'block' AND fold > 0)::INT) AS block
  FROM ruled GROUP BY body),
pieces AS (
  SELECT body, coalesce(allow, 0) AS allow, coalesce(block, 0) AS block, substr('PAD' || body, i, SPAN) AS gram
  FROM (SELECT *, unnest(range(1, length(body) + 1)) AS i FROM texts)),
counted AS (SELECT gram, sum(allow) AS allow, sum(block) AS block FROM pieces GROUP BY gram),LEVELS
scores AS (SELECT body, avg(ln(allow_p) - ln(block_p)) AS score FROM pieces JOIN pTOP USING (gram) GROUP BY body),
scored AS (SELECT r.*, coalesce(s.score, 0) AS score FROM ruled r LEFT JOIN scores s USING (body)),
stats AS (
  SELECT avg(score) FILTER (ruled = 'allow') AS am, avg(score) FILTER (ruled = 'block') AS bm,
         stddev_pop(score) FILTER (ruled = 'allow') AS asd, stddev_pop(score) FILTER (ruled = 'block') AS bsd
  FROM scored WHERE fold = 0),
lim AS (
  SELECT CASE WHEN am IS NULL OR bm IS NULL OR NOT EXISTS (SELECT 1 FROM ruled WHERE ruled = 'allow' AND fold > 0)
                OR NOT EXISTS (SELECT 1 FROM ruled WHERE ruled = 'block' AND fold > 0) THEN 0
              WHEN asd + bsd = 0 THEN (am + bm) / 2 ELSE (am * bsd + bm * asd) / (asd + bsd) END AS t FROM stats)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN score >= (SELECT t FROM lim) THEN 'allow' ELSE 'block' END) AS verdict
FROM scored
"""
# CRC-32 of the decimal page id, bit by bit, as DuckDB lists.
FOLD = ("list_reduce(list_prepend(4294967295::BIGINT, list_transform(split(page_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), "
        "lambda c, x: list_reduce(list_prepend(xor(c, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
        "lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END))")
for _k, _v in {"RULE": _rule(0), "VERDICT": _rule(1), "FOLD": f"xor({FOLD}, 4294967295::BIGINT) % 5", "UPPER": UPPER,
               "LOWER": LOWER, "PAD": PAD, "SPAN": str(ORDER + 1), "LEVELS": "".join(map(_level, range(ORDER + 1))),
               "pTOP": f"p{ORDER}"}.items():
    ORACLE = ORACLE.replace(_k, _v)
