"""URL filter: host and path rules first, then logistic regression on hashed
character n-grams of host and path.

A URL's features are the distinct buckets (``BUCKETS``) of the MD5 of its
n-grams (``GRAMS`` characters long, host and path apart, with their ends
marked), as a vector of length one, and a constant.  The weights come from a
small labelled URL table: full-batch gradient steps on the mean logistic loss
with a small ridge term, from zero.  The whole fit is one expression over one row of
arrays, as the labelled table is small by definition: at most ``most`` URLs
(more is an error).  The weights reach the tables' rows as a scalar subquery, one array of
``BUCKETS`` numbers; pages are neither shuffled nor joined.  Everything is built-in
DataFrame functions.

``LABELLED`` is the table that is used where no other is given: names of
sites as blocklists and directories list them, in the same prefixes, endings and paths
for both labels, so that these say nothing.

Defined cases: a null URL or one without ``://`` has the empty host and the
empty path, which no rule fits; its features are those of empty texts.  Repeated
URLs are judged one by one; an empty table gives no rows; where one of the labels is
missing there is no model: scores are null and what no rule fits is allowed.  Further columns are left behind.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import cut_lineage

BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
#: Size of the constant feature beside a vector of length one.
CONSTANT = 0.25
STEPS, RATE, RIDGE = 400, 12.0, 1e-4
MOST_LABELLED = 1_000

CAPITALS, SMALL_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, rule): a host, which covers its subdomains, and the start of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

# --- fixed values: names of the labelled URL table ---------------------------
BLOCKED_NAMES = (
    "ad-exchange", "ad-tracker", "ads-server", "adserver", "adult-chat", "adult-dating", "adult-videos", "banner-ads",
    "bet-now", "bets-online", "betting-tips", "bonus-casino", "buy-followers", "cam-girls", "cash-loans", "casino-club",
    "casino-online", "cheap-meds", "cheap-replicas", "cheap-watches", "claim-prize", "click-farm", "click-tracker",
    "content-farm", "cracked-keys", "crypto-doubler", "diet-pills", "easy-money", "escort-girls", "fast-cash",
    "free-casino", "free-gifts", "free-money", "free-spins", "get-rich", "hot-singles", "jackpot-win", "link-farm",
    "lotto-winner", "mega-bets", "pay-day-loans", "pills-shop", "pixel-track", "poker-bonus", "popup-ads", "porn-clips",
    "replica-bags", "roulette-win", "sex-cams", "slots-win", "spam-links", "spam-mailer", "sports-bets", "track-clicks",
    "viagra-pills", "warez-free", "web-tracker", "win-prizes", "x-rated", "xxx-adult")
ALLOWED_NAMES = (
    "animals", "archive", "art-gallery", "astronomy", "athletics", "baking-bread", "biology", "birdwatching", "bookshop",
    "botanic-garden", "bridges", "chemistry", "chess-school", "choir", "city-council", "climate-data", "composers",
    "cooking", "cycling-routes", "daily-news", "dictionary", "earth-science", "economics", "education", "engineering",
    "families", "farmers-market", "fishing", "football-results", "forestry", "geography", "geometry", "grammar",
    "handbooks", "harbour", "health-service", "hiking-trails", "history-museum", "hospital", "housing", "insects",
    "journals", "kindergarten", "language-course", "law-reports", "lighthouse", "literature", "local-theatre",
    "mathematics", "medicine", "minerals", "mountain-rescue", "music-school", "national-park", "nutrition", "observatory",
    "open-data", "orchestra", "painting", "parliament", "pharmacology", "philosophy", "photography", "physics", "planets",
    "poetry", "pottery", "public-library", "public-transport", "railway-station", "recipes", "rivers", "sailing",
    "school-trips", "sculpture", "software-manual", "statistics", "surgery", "swimming", "teachers", "translation",
    "travel-diary", "tree-nursery", "university", "veterinary", "village-hall", "volunteers", "weather-report", "weaving",
    "wildlife", "woodwork", "world-atlas", "writers", "yearbook", "zoology")
PREFIXES = ("", "www.", "m.", "blog.", "news.", "shop.", "old.")
ENDINGS = ("example.com", "example.org", "example.net", "example.edu", "example.info")
PATHS = ("/", "/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}", "/index.html", "/page/{}", "/a/{}/b", "")


def labelled_urls(names: Sequence[str]) -> list[str]:
    """One URL for each name, in the prefixes, endings and paths that take turns."""
    return [f"https://{PREFIXES[i % len(PREFIXES)]}{name}.{ENDINGS[i % len(ENDINGS)]}"
            f"{PATHS[i % len(PATHS)].format(37 * i + 11)}" for i, name in enumerate(names)]


#: (url, 1 for block and 0 for allow).
LABELLED = tuple((u, 1) for u in labelled_urls(BLOCKED_NAMES)) + tuple((u, 0) for u in labelled_urls(ALLOWED_NAMES))


def labelled_table(spark: SparkSession, rows: Sequence[tuple[str, int]] = LABELLED) -> DataFrame:
    return spark.createDataFrame(list(rows), "url string, label int")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return (F.coalesce(F.translate(host, CAPITALS, SMALL_LETTERS), F.lit("")), F.coalesce(path, F.lit("")))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(the longest rule that fits, its verdict), null where none does."""
    found = verdict = F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + start))
        found, verdict = F.when(fits, rule).otherwise(found), F.when(fits, kind).otherwise(verdict)
    return found, verdict


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once a row, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _buckets(text: Column, mark: str) -> Column:
    """Buckets of the n-grams of ``text`` between two end marks, one by one
    from an array of characters, so that long texts cost in proportion."""
    def grams(chars: Column, n: int) -> Column:
        starts = F.when(F.size(chars) >= n, F.sequence(F.lit(0), F.size(chars) - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), *[F.get(chars, i + k) for k in range(n)]))

    every = _let(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""),
                 lambda chars: F.flatten(F.array(*[grams(chars, n) for n in GRAMS])))
    return F.transform(every, lambda g: F.conv(F.substring(F.md5(g), 1, 4), 16, 10).cast("int"))


def features(host: Column, path: Column) -> Column:
    """Distinct buckets of a URL."""
    return F.array_distinct(F.concat(_buckets(host, "h"), _buckets(path, "p")))


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, v: a + v)


def _sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def _length(buckets: Column) -> Column:
    return F.sqrt(F.greatest(F.size(buckets), F.lit(1)).cast("double"))


def fit(labelled: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """One row: ``weights``, an array of BUCKETS numbers, and ``constant`` (null
    where one of the labels is missing).

    ``labelled`` has url and label (1 block, 0 allow; rows with another label
    don't count, the larger label of a repeated URL holds).  A gradient step adds a multiple of each
    URL's vector to the weights, so the steps are run on these multiples,
    one number a URL, with the table of the vectors' products."""
    rows = (labelled.filter(F.col("label").isin(0, 1)).groupBy("url").agg(F.max("label").cast("double").alias("y"))
            .select("url", "y", F.array_sort(features(*host_and_path(F.col("url")))).alias("x")))
    table = rows.agg(F.array_sort(F.collect_list(F.struct("url", "y", "x"))).alias("all")).select(
        F.when(F.size("all") > most, F.raise_error(F.lit(f"more than {most} labelled URLs")).cast("array<double>"))
        .otherwise(F.col("all.y")).alias("y"), F.col("all.x").alias("xs"), F.size("all").alias("n"))
    table = table.filter(F.array_contains("y", F.lit(0.0)) & F.array_contains("y", F.lit(1.0)))
    products = F.transform("xs", lambda p: F.transform("xs", lambda q: F.size(F.array_intersect(p, q)).cast("double")
                                                       / (_length(p) * _length(q)) + F.lit(CONSTANT ** 2)))

    def step(a: Column) -> Column:
        return F.transform("products", lambda p, i: F.get(a, i) * F.lit(1 - RATE * RIDGE) + F.lit(RATE) / F.col("n") * (
            F.get("y", i) - _sigmoid(_sum(F.zip_with(p, a, lambda u, v: u * v)))))

    # written, so that no step works them out again; one row
    table = cut_lineage(table.withColumn("products", products))
    learnt = cut_lineage(table.select("xs", F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)), F.transform("y", lambda _: F.lit(0.0)), lambda a, _: step(a)).alias("a")))
    each = learnt.select(F.explode(F.arrays_zip("xs", "a")).alias("r"))
    every = labelled.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b"), F.lit(0.0).alias("w"))
    dense = (each.select(F.explode("r.xs").alias("b"), (F.col("r.a") / _length(F.col("r.xs"))).alias("w"))
             .unionByName(every).groupBy("b").agg(F.sum("w").alias("w")))
    weights = dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "w"))), lambda s: s["w"]).alias("weights"))
    constant = learnt.select((_sum(F.col("a")) * F.lit(CONSTANT ** 2)).alias("constant"))
    return cut_lineage(weights.withColumn("constant", constant.scalar()))


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES,
          key: str = "page_id") -> DataFrame:
    """page_id, host, path, rule, verdict and the classifier's ``score`` (0 to 1, block from 0.5)."""
    labelled = labelled_table(pages.sparkSession) if labelled is None else labelled
    host, path = host_and_path(F.col("url"))
    model = fit(labelled)
    cut = pages.select(F.col(key), host.alias("host"), path.alias("path"),
                       model.select("weights").scalar().alias("w"), model.select("constant").scalar().alias("c"))
    raw = _let(features(F.col("host"), F.col("path")), lambda x: F.aggregate(
        x, F.lit(0.0), lambda a, b: a + F.get("w", b)) / _length(x)) + F.col("c")
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    score = F.round(_sigmoid(raw), 6)
    return cut.select(key, "host", "path", rule.alias("rule"), verdict.alias("verdict"), score.alias("score")).withColumn(
        "verdict", F.coalesce("verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")))
