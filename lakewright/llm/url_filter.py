"""URL filter: host and path rules, else logistic regression on hashed character n-grams.

All of it is DataFrame functions: URLs are split by regular expressions, rules
are one CASE over a bounded rule list, and the regression is trained by gradient
steps over a small labelled URL table. Its weights are a sum of the examples'
features (each URL's n-gram counts over the square root of their number, less
the table's mean), so a step works on the examples' inner products: the table
is joined with itself by bucket once, and aggregate() folds the steps over one
row. Only the SIZE + 1 weights reach the driver; they are a literal in the plan.

Host: after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased.
Path: from there up to "?", "#" or the end. A null URL or one without "://" has
an empty host and path; the labelled table has that case, as one to allow.
A rule fits its host and all subdomains if the path starts with the rule's path;
the longest rule wins, the first in order among equals. Without a rule a URL is
blocked where the regression's probability is BLOCK_AT or more. Very long URLs
are read whole. Repeated rows are judged each; empty tables give empty results;
without labelled rows everything is allowed. Added columns replace columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Buckets (three hexadecimal digits of MD5), lengths of n-grams, gradient steps, their rates and the decay of weights.
SIZE, GRAMS, STEPS, RATE, BIAS_RATE, DECAY = 4096, (3, 4), 60, 0.3, 0.005, 0.005
#: Blocking a page that is fine costs more than missing one.
BLOCK_AT = 0.65
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of the labelled table: what hosts to block and to allow are named after, and what goes with either. labelled_rows() makes its hosts of them by rule, in domains that are reserved for examples.
BLOCKED = "casino poker slots jackpot roulette betting bets gamble lottery pills viagra pharmacy steroids xxx adult porn sexcam escort hookup adserver ads clicks popup banner tracker spam phishing malware trojan keygen cracked warez payday prize giveaway replica fake cheap bonus scam".split()
ALLOWED = (
    "news weather library museum university school recipes garden physics history travel docs code council hospital theatre music birds maps archive science health bank bakery bicycle books camera castle chemistry choir church climate "
    "coffee college cooking dance design energy family farm film forest geology harbour hiking insurance journal kitchen language law letters market maths medicine nature ocean opera painting park philosophy photo poetry press radio "
    "railway river sailing statistics story studio tennis tourism village water wine winter wood zoo"
).split()
WITH = "online best live top city world house daily guide group free my".split()
SUBDOMAINS = ["", "www.", "m.", "blog.", "shop."]
DOMAINS = ["example", "example.com", "example.net", "example.org", "test"]
PATHS = ["/", "/en/{}", "/fr/{}.html", "/de/{}/", "/es/{}", "/a/b/{}", "/index.html?p={}", "", "/2021/{}/x"]


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_col: Column, path_col: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule of (verdict, "host/path") rules, else null."""
    out = None
    for _, rule in sorted(rules, key=lambda r: -len(r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host_col == domain) | host_col.endswith("." + domain)) & path_col.startswith(slash + rest)
        out = F.when(fits, rule) if out is None else out.when(fits, rule)
    return F.lit(None).cast("string") if out is None else out


def features(host_col: Column, path_col: Column) -> Column:
    """Buckets of the character n-grams of "^host/path$"."""
    text = F.concat(F.lit("^"), host_col, path_col, F.lit("$"))

    def buckets(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.conv(F.substring(F.md5(F.substring(text, i, F.lit(n))), 1, 3), 16, 10).cast("int"))

    return F.concat(*[buckets(n) for n in GRAMS])


def invented(i: int) -> str:
    """A host name that means nothing: two to four syllables of a consonant and a vowel."""
    return "".join("bcdfglmnprstvz"[(i * (j * 4 + 3) + j * 5) % 14] + "aeiou"[(i * (j + 2) + j) % 5] for j in range(2 + i % 3))


def labelled_rows(blocked: list[str] | None = None, allowed: list[str] | None = None) -> list[tuple[str, int]]:
    """The labelled URL table: (url, 1 to block or 0 to allow), all different."""
    blocked, allowed, out = blocked or BLOCKED, allowed or ALLOWED, []

    def put(stem: str, y: int, path: str | None = None) -> None:
        k = len(out) + 1
        path = PATHS[k * 5 % 9].format(k * 911 % 9973) if path is None else path
        out.append((f"http{'s' if k % 3 else ''}://{SUBDOMAINS[k * 7 % 5]}{stem}.{DOMAINS[k * 3 % 5]}{path}", y))

    for i, w in enumerate(blocked):
        for stem in (w, f"{WITH[i % 12]}-{w}", f"{w}-{blocked[(i * 7 + 3) % len(blocked)]}", f"{w}{WITH[(i * 5 + 2) % 12]}"):
            put(stem, 1)
    for i, w in enumerate(allowed):
        put(f"{WITH[i % 12]}-{w}", 0)
        put(f"{w}-{allowed[(i * 7 + 3) % len(allowed)]}" if i % 2 else f"{w}{WITH[(i * 5 + 2) % 12]}", 0)
    for i in range(60):
        put(invented(i), 0, f"/{allowed[i % len(allowed)]}/{i * 37}" if i % 4 == 0 else None)
    for i, w in enumerate(blocked):  # what a path says, under names that say nothing
        put(invented(i + 200), int(i % 2 == 0), f"/{w if i % 2 == 0 else allowed[i % len(allowed)]}/{i * 37}")
    return [*out, ("", 0)]


def labelled(spark: SparkSession) -> DataFrame:
    """labelled_rows() as a table."""
    return spark.createDataFrame(labelled_rows(), "url string, y int")


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)


def train(examples: DataFrame) -> list[float]:
    """Weights of the buckets and, last, the bias; examples (url, y) are a small table, of which rows without a label aren't read."""
    known = examples.where("y IS NOT NULL").select("url", F.col("y").cast("double").alias("y"))
    known = known.withColumns({"i": F.row_number().over(Window.orderBy("url", "y")) - 1, "n": F.count("*").over(Window.partitionBy())})  # a table of some hundred rows
    grams = known.withColumn("f", features(host(F.col("url")), path(F.col("url"))))
    x = grams.select("i", F.explode("f").alias("j"), F.size("f").alias("n")).groupBy("i", "j").agg((F.count("*") / F.sqrt(F.first("n"))).alias("v"))
    other = x.select(F.col("i").alias("k"), "j", F.col("v").alias("u"))
    products = x.join(other, "j").groupBy("i", "k").agg(F.sum(F.col("v") * F.col("u")).alias("p"))
    every = known.select("i", "y", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("k")).join(products, ["i", "k"], "left").fillna(0.0, ["p"])
    means = every.groupBy("i").agg(F.avg("p").alias("m")).withColumn("all", F.avg("m").over(Window.partitionBy()))
    # inner products of what differs from the mean
    other_means = means.select(F.col("i").alias("k"), F.col("m").alias("m_k"))
    centred = every.join(means, "i").join(other_means, "k").select("i", "y", "k", (F.col("p") - F.col("m") - F.col("m_k") + F.col("all")).alias("p"))
    rows = centred.groupBy("i").agg(F.first("y").alias("y"), F.sort_array(F.collect_list(F.struct("k", "p"))).alias("row"))
    table = rows.agg(F.sort_array(F.collect_list(F.struct("i", "y", F.transform("row", lambda x: x["p"]).alias("p")))).alias("t")).where(F.size("t") > 0)
    # the aggregate's fields are read once a step: nothing above is computed again in the lambdas
    table = table.select(F.transform("t", lambda r: r["p"]).alias("p"), F.transform("t", lambda r: r["y"]).alias("y")).groupBy().agg(F.first("p").alias("p"), F.first("y").alias("y")).where("y IS NOT NULL")

    def step(state: Column, _: Column) -> Column:
        told = F.transform("p", lambda r: state["b"] + _sum(F.zip_with(r, state["a"], lambda p, a: p * a)))
        errors = F.zip_with("y", told, lambda y, z: y - 1 / (1 + F.exp(-z)))
        # the fold over one element binds the errors
        return F.aggregate(F.array(errors), state, lambda s, e: F.struct(F.zip_with(s["a"], e, lambda a, d: a * (1 - RATE * DECAY) + RATE * d).alias("a"), (s["b"] + BIAS_RATE * _sum(e)).alias("b")))

    start = F.struct(F.transform("y", lambda _: F.lit(0.0)).alias("a"), F.lit(0.0).alias("b"))
    solved = table.select(F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step).alias("m")).groupBy().agg(F.first("m").alias("m")).where("m IS NOT NULL")
    solved = solved.select("m.a", "m.b", (_sum(F.col("m.a")) / F.size("m.a")).alias("shift"), F.size("m.a").alias("n"))
    shares = solved.select(F.posexplode("a").alias("i", "a"), "shift", "b", "n")
    weights = x.join(shares, "i").groupBy("j").agg(F.sum((F.col("a") - F.col("shift")) * F.col("v")).alias("w"), (F.sum("v") / F.first("n")).alias("m"), F.first("b").alias("b"))
    out, bias = [0.0] * SIZE, 0.0
    rows = weights.collect()  # SIZE rows at most
    for r in rows:
        out[r["j"]] = r["w"]
    if rows:
        bias = rows[0]["b"] - math.fsum(r["w"] * r["m"] for r in rows)
    return [*out, bias]


def judge(df: DataFrame, weights: list[float], rules: list[tuple[str, str]], url_col: str = "url") -> DataFrame:
    """df with host, path, rule, block_score and verdict."""
    # one foldable text, so the plan holds an array and not SIZE literals
    w, bias = F.split(F.lit(",".join(map(repr, weights[:-1]))), ",").cast("array<double>"), F.lit(weights[-1])
    url, f = F.col(url_col), features(F.col("host"), F.col("path"))
    start = F.struct(F.lit(0.0).alias("w"), F.lit(0).alias("n"))
    per_gram = F.aggregate(f, start, lambda a, j: F.struct((a["w"] + F.get(w, j)).alias("w"), (a["n"] + 1).alias("n")), lambda a: a["w"] / F.sqrt(a["n"]))
    rated = df.withColumns({"host": host(url), "path": path(url)}).withColumn("block_score", bias + per_gram)
    rated = rated.withColumn("block_score", 1 / (1 + F.exp(-F.col("block_score"))))
    verdicts = F.create_map(*[F.lit(x) for verdict, rule in rules for x in (rule, verdict)]) if rules else None
    ruled = rated.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    method = F.when(F.col("block_score") >= BLOCK_AT, "block").otherwise("allow")
    return ruled.withColumn("verdict", F.coalesce(F.try_element_at(verdicts, F.col("rule")), method) if rules else method)


def oracle_sql(rules: list[tuple[str, str]]) -> str:
    """The same training and verdicts in DuckDB SQL, over the table `pages`."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def parts(url: str) -> str:
        return f"coalesce(translate(regexp_extract({url}, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host, coalesce(regexp_extract({url}, '://[^/?#]*([^?#]*)', 1), '') AS path"

    grams = " || ".join(f"list_transform(range(1, greatest(length(s) - {n - 1}, 1) + 1), lambda i: ('0x' || substr(md5(substr(s, i, {n})), 1, 3))::INT)" for n in GRAMS)
    values = ", ".join(f"({quoted(u)}, {y}::DOUBLE)" for u, y in labelled_rows())
    ordered = sorted(rules, key=lambda r: -len(r[1]))

    def case(result: str) -> str:
        whens = []
        for verdict, rule in ordered:
            domain, slash, rest = rule.partition("/")
            whens.append(f"WHEN (host = {quoted(domain)} OR ends_with(host, {quoted('.' + domain)})) AND starts_with(path, {quoted(slash + rest)}) THEN {quoted(rule if result == 'rule' else verdict)}")
        return f"CASE {' '.join(whens)} END"

    return f"""WITH RECURSIVE known AS (SELECT url, y, row_number() OVER (ORDER BY url, y) - 1 AS i FROM (VALUES {values}) v(url, y)),
grams AS (SELECT i, {grams} AS f FROM (SELECT i, '^' || host || path || '$' AS s FROM (SELECT i, {parts("url")} FROM known))),
x AS (SELECT i, j, count(*) / sqrt(any_value(n)) AS v FROM (SELECT i, unnest(f) AS j, len(f) AS n FROM grams) GROUP BY 1, 2),
products AS (SELECT a.i, b.i AS k, sum(a.v * b.v) AS p FROM x a JOIN x b ON a.j = b.j GROUP BY 1, 2),
dense AS (SELECT a.i, b.i AS k, coalesce(p, 0) AS p FROM known a CROSS JOIN known b LEFT JOIN products ON products.i = a.i AND products.k = b.i),
means AS (SELECT i, avg(p) AS m FROM dense GROUP BY 1),
centred AS (SELECT d.i, list(d.p - a.m - b.m + (SELECT avg(m) FROM means) ORDER BY d.k) AS r FROM dense d JOIN means a ON a.i = d.i JOIN means b ON b.i = d.k GROUP BY 1),
one AS (SELECT list(r ORDER BY i) AS p, list(y ORDER BY i) AS y FROM centred JOIN known USING (i)),
steps AS (SELECT 0 AS k, list_transform(y, lambda t: 0::DOUBLE) AS a, 0::DOUBLE AS b FROM one UNION ALL
SELECT k + 1, list_transform(list_zip(a, e), lambda t: t[1] * (1 - {RATE} * {DECAY}::DOUBLE) + {RATE}::DOUBLE * t[2]), b + {BIAS_RATE}::DOUBLE * list_sum(e)
FROM (SELECT k, a, b, list_transform(list_zip(one.p, one.y), lambda t: t[2] - 1 / (1 + exp(-(b + list_dot_product(t[1], a))))) AS e FROM steps, one WHERE k < {STEPS})),
solved AS (SELECT unnest(a) AS a, generate_subscripts(a, 1) - 1 AS i, list_avg(a) AS shift, b, len(a) AS n FROM steps WHERE k = {STEPS}),
weights AS (SELECT j, sum((a - shift) * v) AS w, sum(v) / any_value(n) AS m, any_value(b) AS b FROM x JOIN solved USING (i) GROUP BY 1),
bias AS (SELECT any_value(b) - sum(w * m) AS b FROM weights),
split AS (SELECT page_id, {parts("url")} FROM pages),
urls AS (SELECT DISTINCT host, path FROM split),
rated AS (SELECT host, path, any_value(n) AS n, sum(coalesce(w, 0)) AS w FROM (SELECT host, path, unnest(f) AS j, len(f) AS n FROM (SELECT host, path, {grams} AS f FROM (SELECT host, path, '^' || host || path || '$' AS s FROM urls))) LEFT JOIN weights USING (j) GROUP BY 1, 2)
SELECT page_id, host, path, {case("rule")} AS rule, coalesce({case("verdict")}, CASE WHEN 1 / (1 + exp(-((SELECT b FROM bias) + w / sqrt(n)))) >= {BLOCK_AT} THEN 'block' ELSE 'allow' END) AS verdict FROM split JOIN rated USING (host, path)"""
