"""URL filter: logistic regression on hashed character n-grams of host and path, behind host/path
rules (operator 2).  DataFrame and Spark ML operations only.

The classifier is trained from a small labelled URL table (``labelled_urls``, or any table of url and
label).  Each n-gram counts once for each time it occurs; n-grams of host and path are apart.

Defined results: a null url, or one without ``://``, has empty host and path, no rule, and the
verdict ``allow`` (there is nothing to judge); a host or path shorter than an n-gram gives no
n-gram of that length; repeated rows are judged each for itself; other columns are dropped.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: (host, start of the path, verdict); a rule holds for its host and all subdomains, the longest wins.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# The names that the small labelled URL table is made of, from general knowledge of the web.
GOOD_NAMES = """library museum university weather recipes gardening history physics hospital school council parliament
railway bakery chess astronomy football hiking photography kernel manual wiki encyclopedia journal newspaper theatre
orchestra cathedral mountain kitchen bicycle carpentry dictionary climate ocean geology algebra poetry novels birds
airport timetable bookshop archive gallery observatory chemistry biology medicine nursing charity village station
travel hotels maps software hardware compiler database research thesis lectures courses science culture heritage
economy finance bank insurance energy forest rivers tides sailing harbour fishing essex wessex middlesex
documentation tutorial reference standards community volunteers children family education learning""".split()
BAD_NAMES = """poker roulette jackpot slots blackjack bingo lottery gambling betting sportsbook wagers bookies
viagra cialis tramadol pharmacy steroids weightloss slimming miracle painkillers
porn xxx sexcams escorts nudes hookups milf fetish livesex webcamgirls
adserver adclick popunder banners clickbait tracker trackers tracking pixel affiliate doubleclick adnetwork advertiser
spammer spammers spamming linkbuilder backlinks seoboost bulkmail massmailer autosurf
payday loans quickcash bitcoindoubler getrich replica rolex knockoff warez keygen cracked torrents phishing
malware ransomware giveaway prizes winner freebies freeiphone cheapest discounts clearance dealz""".split()
GOOD_PATHS = ("/books/history", "/courses/physics", "/guide/install", "/recipes/soup", "/results/2020", "/about")
BAD_PATHS = ("/poker/jackpot", "/viagra/order", "/betting/odds", "/xxx/livesex", "/adclick/banner", "/payday-loans/apply")
# End of the fixed values.
#: Both classes have the same shapes, on domains reserved for examples, so that only the names tell them apart.
SHAPES = ("https://{0}.example.com/", "http://www.{0}-{1}.example.net/en/1?a=b", "https://{0}{1}.example.org/fr/1.html",
          "https://blog.{1}-{0}.example.com/es/1/", "http://m.{0}.example.net/de/1")


def labelled_urls() -> list[tuple[str, float]]:
    """The small labelled table (1: block): each name alone and beside another of its kind, in a few shapes;
    then paths on good hosts."""
    rows = []
    for y, names in ((0.0, GOOD_NAMES), (1.0, BAD_NAMES)):
        for i, name in enumerate(names):
            rows += [(shape.format(name, names[(7 * i + 3 * k + 1) % len(names)]), y) for k, shape in enumerate(SHAPES)]
    return rows + [(f"https://www.{name}.org{p}", y) for y, paths in ((0.0, GOOD_PATHS), (1.0, BAD_PATHS))
                   for name in GOOD_NAMES[:6] for p in paths]


SIZES = (3, 4, 5)
FEATURES = 1 << 14


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path of a url; both empty without ``://``."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def grams(chars: str, name: str) -> Column:
    """All character n-grams, in the given sizes, of the column ``chars`` of characters, marked with ``name``."""
    def of(n: int) -> Column:
        last = F.size(chars) - n
        starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit(f"{name}{n}:"), *(F.get(F.col(chars), i + k) for k in range(n))))

    return F.concat(*(of(n) for n in SIZES))


def featurize(pages: DataFrame) -> DataFrame:
    """``pages`` (url, ...) with host, path and the hashed n-gram counts."""
    host, path = host_and_path(F.col("url"))
    rows = pages.withColumn("host", host).withColumn("path", path)
    # "." and "/" mark where host labels and path segments begin and end; all digits count as the same.
    # The characters are columns, cut once: a substring would be searched from the text's start each time.
    for name, text in (("_host", F.concat(F.lit("."), "host", F.lit("."))), ("_path", F.concat("path", F.lit("/")))):
        rows = rows.withColumn(name, F.regexp_extract_all(F.translate(text, "123456789", "000000000"), F.lit("(?s)."), 0))
    rows = rows.withColumn("grams", F.concat(grams("_host", "h"), grams("_path", "p"))).drop("_host", "_path")
    return HashingTF(numFeatures=FEATURES, inputCol="grams", outputCol="features").transform(rows).drop("grams")


def fit(spark: SparkSession, labelled: DataFrame | None = None) -> LogisticRegressionModel:
    """Learn from ``labelled`` (url, label 0/1); by default the table of this module."""
    if labelled is None:
        rows = ", ".join(f"('{url}', {label}D)" for url, label in labelled_urls())
        labelled = spark.sql(f"SELECT * FROM VALUES {rows} AS t (url, label)")
    return LogisticRegression(regParam=0.02, maxIter=100).fit(featurize(labelled).coalesce(1))


def matching_rule(host: Column, path: Column) -> tuple[Column, Column]:
    """(rule as host and path, its verdict), null where none fits; the longest rule is tried first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, model: LogisticRegressionModel) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the model's probability of block) per page."""
    from pyspark.ml.functions import vector_to_array

    rows = featurize(pages.select(F.col("page_id").cast("long").alias("page_id"), "url"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"))
    scored = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    judged = F.when((F.concat("host", "path") != "") & (F.col("score") >= 0.5), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, judged).alias("verdict"),
                         "score")
