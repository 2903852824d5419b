"""URL filter: rules for hosts and paths, and for all other urls a logistic
regression on hashed character n-grams of host and path.

Built-in column functions and Spark's own regression only. An n-gram costs the
same wherever it stands in the url, so long urls stay linear.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path

GRAMS = (3, 4, 5)
BUCKETS = 1 << 16
PENALTY = 0.002
LEVEL = 0.5  # least probability that blocks

# The small labelled url table, by host and path.
BLOCKED = """
casino-royal.com/en/12  best-casino.net/slots  online-casino.org/de/4  lucky-casino.example.com/en/77
poker-bonus.com/join  bets-now.net/en/5  sure-bets.org/tips/9  free-bet.info/fr/2  sport-bets.example.org/en/640
win-big.net/prize  you-win.com/claim/3  jackpot-win.org/es/8  casino-winner.example.net/en/31
pills-online.com/buy  cheap-meds.net/order/4  diet-pills.org/en/15  cheap-viagra.com/shop  pills-store.example.com/fr/6
cheap-watches.com/sale  cheap-loans.net/apply  payday-loans.org/fast  replica-cheap.example.org/en/218
spam-links.com/a/1  spammers.net/list  link-farm.org/en/2  seo-farm.com/out/7  spam-host.example.net/de/90
ads-server.com/click  adserver.net/banner/2  track-click.com/r/5  tracker.net/pixel  ads-network.example.com/en/3
click-track.org/go/8  affiliate-ads.com/ref  popup-ads.net/x  free-gifts.com/claim  free-money.net/now
free-porn.com/video/1  adult-videos.org/new  adult-pics.example.net/en/19  xxx-cams.net/live  adult-dates.org/join  hot-sex.com/pics  warez-crack.net/keygen
torrent-crack.org/get/4  hack-tools.net/download  win-iphone.com/survey  bitcoin-double.net/invest  rolex-replica.com/buy
""".split()
ALLOWED = """
www.riverside-news.com/en/12  blog.gardening.net/en/5  www.city-library.org/de/4  m.weather-today.com/en/77
docs.software.org/guide/3  wiki.history.net/fr/2  university.edu/research/9  museum.org/es/8  www.town-hall.gov/en/640
recipes.kitchen.com/soup  www.science-journal.org/articles/31  school.net/lessons  blog.travel-notes.com/en/15
www.hospital.org/contact  orchestra.example.com/en/6  www.bakery.example.net/fr/218  theatre.example.org/de/2
blog.mountain.example.com/en/90  www.nature.example.org/es/33  m.reader.example.net/en/401  forum.cycling.com/t/88
painting.example.org/en/14  www.harbour.example.com/fr/57  blog.astronomy.example.net/de/871  letters.example.org/en/9
www.thornton.example.com/en/512  blog.interior.example.net/en/26  northern.example.org/en/735  other.example.com/es/64
m.stationery.example.com/fr/3  www.rhythm.example.net/en/120  heather.example.org/en/955  further.example.com/de/48
news.market.com/economy/2  www.football-club.org/results  cinema.net/programme  radio.org/live  poetry.com/verse/7
books.publisher.com/en/11  www.station.example.net/en/300  blog.ethics.example.org/en/81  gardens.example.com/en/5
""".split()


@dataclass(frozen=True)
class Rule:
    """``host/path`` (host and all its subdomains, paths that begin so) and
    what becomes of such urls: allow or block."""

    where: str
    verdict: str

    @property
    def host(self) -> str:
        return self.where.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.where.partition("/")[2]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): between the first ``://`` and ``/``, ``?``, ``#`` or the
    end, A-Z lower-cased; then up to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def fitting(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as struct (n, rule, verdict); null if none.
    Looks up the host's endings of at most as many labels as a rule has."""
    by_host: dict[str, list[Rule]] = {}
    for r in rules:
        by_host.setdefault(r.host, []).append(r)
    if not by_host:
        return F.lit(None).cast("struct<n:int,rule:string,verdict:string>")
    entry = lambda r: F.struct(F.lit(len(r.where)).alias("n"), F.lit(r.where).alias("rule"),
                               F.lit(r.verdict).alias("verdict"), F.lit(r.path).alias("path"))
    known = F.create_map(*[c for h, some in by_host.items() for c in (F.lit(h), F.array(*map(entry, some)))])
    depth = max(h.count(".") for h in by_host) + 1
    endings = F.array_distinct(F.array(*[F.substring_index(host, ".", -k) for k in range(1, depth + 1)]))
    found = F.flatten(F.filter(F.transform(endings, lambda e: F.try_element_at(known, e)), lambda x: x.isNotNull()))
    fits = F.filter(found, lambda r: F.startswith(path, r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(r["n"].alias("n"), r["rule"].alias("rule"),
                                                            r["verdict"].alias("verdict"))))
    return F.when(F.size(fits) > 0, best)


def _grams(text: Column, mark: str) -> list[Column]:
    chars = F.split(text, "")

    def runs(n: int) -> Column:
        one = lambda c, i: F.concat(F.lit(f"{mark}{n}"), *[F.get(chars, i + k) for k in range(n)])
        return F.filter(F.transform(chars, one), lambda g: g.isNotNull())  # null past the end
    return [runs(n) for n in GRAMS]


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host (with its edges) and path, marked apart."""
    return F.concat(*_grams(F.concat(F.lit("^"), host, F.lit("$")), "h"), *_grams(path, "p"))


def labelled(spark: SparkSession) -> DataFrame:
    """(url, label): the small labelled url table."""
    rows = [("https://" + u, 1.0) for u in BLOCKED] + [("https://" + u, 0.0) for u in ALLOWED]
    return spark.createDataFrame(rows, "url string, label double")


def learn(urls: DataFrame, prefix: str = "url__") -> PipelineModel:
    """Hashing and regression fitted to ``urls`` (url, label)."""
    hashing = HashingTF(inputCol=prefix + "grams", outputCol=prefix + "v", numFeatures=BUCKETS, binary=True)
    regression = LogisticRegression(featuresCol=prefix + "v", labelCol="label", probabilityCol=prefix + "q",
                                    rawPredictionCol=prefix + "r", predictionCol=prefix + "p", regParam=PENALTY,
                                    maxIter=60)
    rows = urls.select("label", grams(*split_url(F.col("url"))).alias(prefix + "grams")).coalesce(1)
    # Stored and read again, the model is its coefficients alone: a fitted one
    # carries its training summary, and with it the session, into every task.
    path = scratch_path(urls.sparkSession, "url-model")
    regression.fit(hashing.transform(rows)).write().save(path)
    return PipelineModel([hashing, LogisticRegressionModel.load(path)])


def judge(pages: DataFrame, rules: list[Rule], model: PipelineModel, prefix: str = "url__") -> DataFrame:
    """(page_id, host, path, rule, verdict, blocked_probability) of every row.

    A null url, or one without ``://``, has an empty host and path and gets
    the model's verdict on them; repeated rows are judged each; equal rules
    of one length can't both be the longest, as they would be the same text.
    Other columns are ignored.
    """
    host, path = split_url(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fit", fitting(rules, F.col("host"), F.col("path")))
    rows = rows.withColumn(prefix + "grams", grams(F.col("host"), F.col("path")))
    out = model.transform(rows).withColumn("blocked_probability", vector_to_array(F.col(prefix + "q"))[1])
    said = F.when(F.col("blocked_probability") >= LEVEL, "block").otherwise("allow")
    return out.select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                      F.coalesce("fit.verdict", said).alias("verdict"), "blocked_probability")


def filter_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """:func:`judge` with the model of the small labelled url table."""
    return judge(pages, rules, learn(labelled(pages.sparkSession)))
