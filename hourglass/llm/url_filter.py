"""URL filter: list rules first, a logistic regression for the URLs that no rule decides.

The regression works on hashed character n-grams of host and path and is trained from a
small labelled URL table (`labelled_urls`); without one, from URLs that the rules decide.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.common import ascii_lower

#: (rule, verdict): host, then path prefix from the first slash on
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
#: names of hosts, labelled by hand from what the words say, whatever the rules are: gambling, pills, adult, adverts and
#: tracking, spam and fraud are unwanted; the others are everyday names in four languages, plain and of two parts. No name
#: is that of a host of the test tables
UNWANTED = tuple("""casino online-casino best-casino casino-bonus bets sports-bets betting-odds poker poker-room slots slots-jackpot
jackpot-city roulette blackjack-table cheap-drugs pills-shop pills viagra-shop pharmacy-deals diet-pills steroids-store
adult adult-video adult-chat xxx-cams xxx porn-tube porn sex-chat escort-girls nude-photos ads ads-server ad-click click-ads
click-track tracker-ads tracking-pixel banner-ads popup-ads popunder content-farm spam link-farm seo-spam bulk-mail payday-loans
fast-loans free-money free-iphone get-rich easy-cash free-prize prize-winner warez-crack crack-keys keygen torrent-crack
phish-login fake-watches replica-bags malware-download""".split())
ORDINARY = tuple("""news weather city-news museum library school science history travel recipes garden music theatre sports
football health doctor hospital university research books reading letters nature mountain river forest ocean island family
children farming-tips kitchen workshop engine railway station harbour market bakery shoemaker software computer network
free-software open-data photo-album track-and-field green-farm winter-sports address-book nachrichten wetter stadt zeitung
bibliothek schule wissenschaft geschichte reisen garten musik gesundheit strasse bahnhof nouvelles meteo ville journal
bibliotheque ecole histoire voyage cuisine jardin musique sante gare noticias tiempo ciudad periodico biblioteca escuela
ciencia historia viajes cocina jardin-botanico salud estacion bicycle camera coffee-house dentist electric fashion furniture
gallery hotel insurance lawyer magazine newspaper office painting quilting restaurant sailing uniform village wedding yoga
zoo archive bridge-builders chess-club choir church council courthouse dance-school dictionary diving encyclopedia fishing
geology handbook language-course mathematics observatory orchestra parliament philosophy pottery reading-room shelter
swimming tutorial veterinary weaving""".split())
#: what stands before and after each of the names alike, so that neither domain nor language nor path tells the label
PREFIXES = ("", "www.", "m.", "blog.")
DOMAINS = ("example.com", "example.net", "example.org")
LANGUAGES = ("en", "de", "fr", "es")
TAILS = ("", "/", ".html")
#: labelled URLs the regression is trained from, at most: those with the smallest hashes
TRAIN_ROWS = 10_000
FEATURES = 1 << 12
GRAMS = (3, 4)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case A-Z, and path; both empty for a null url or one without ://."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return (ascii_lower(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit("")))


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (by code points; of equally long ones the first in code
    point order) and its verdict, or nulls."""
    rule = verdict = None
    for text, says in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(F.lit(f".{name}"))) & path.startswith(F.lit(slash + rest))
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    return (rule, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def grams(host: Column, path: Column, sizes=GRAMS) -> Column:
    """Character n-grams of host and path, each with its part's mark and with its ends."""
    def of(text: Column, mark: str, n: int) -> Column:
        # characters are cut apart once, so that time is linear in the URL
        framed = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(framed) - (n - 1)))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.array_join(F.slice(framed, i, F.lit(n)), "")))

    return F.concat(*[of(text, mark, n) for text, mark in ((host, "h"), (path, "p")) for n in sizes])


class UrlModel:
    """A trained regression; `score` adds the chance that a URL is to be blocked."""

    def __init__(self, model):
        self.model = model

    def score(self, urls: DataFrame, out: str = "block_score") -> DataFrame:
        """`urls` has host and path; other columns stay."""
        if self.model is None:
            return urls.withColumn(out, F.lit(0.0))
        hashed = _features(urls)
        scored = self.model.transform(hashed)
        return scored.withColumn(out, vector_to_array("_chance")[1]).drop("_grams", "_vector", "_raw", "_chance", "_class")


def _features(urls: DataFrame) -> DataFrame:
    with_grams = urls.withColumn("_grams", grams(F.col("host"), F.col("path")))
    return HashingTF(inputCol="_grams", outputCol="_vector", numFeatures=FEATURES, binary=True).transform(with_grams)


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> UrlModel:
    """`labelled` has host, path and block (1.0 or 0.0). Trained from at most `rows`
    distinct rows; with labels of one kind only, or none, every score is that label's or 0."""
    bounded = labelled.select("host", "path", F.col("block").cast("double").alias("block")).distinct()
    bounded = bounded.orderBy(F.xxhash64("host", "path"), "host", "path", "block").limit(rows)
    if bounded.isEmpty():
        return UrlModel(None)
    fit = LogisticRegression(featuresCol="_vector", labelCol="block", rawPredictionCol="_raw", probabilityCol="_chance",
                             predictionCol="_class", maxIter=25, regParam=0.001, standardization=False)
    return UrlModel(fit.fit(_features(bounded)))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled URL table: host, path and block, twelve URLs of every name."""
    def named(names: tuple[str, ...], block: float) -> DataFrame:
        return spark.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("name"), F.lit(block).alias("block"))

    shapes = [F.struct(F.lit(prefix).alias("before"), F.lit(f".{domain}").alias("after"),
                       F.lit(f"/{LANGUAGES[(i + j) % 4]}/{1000 + 617 * (3 * i + j)}{TAILS[(i + j) % 3]}").alias("path"))
              for i, prefix in enumerate(PREFIXES) for j, domain in enumerate(DOMAINS)]
    urls = named(UNWANTED, 1.0).unionByName(named(ORDINARY, 0.0)).withColumn("shape", F.explode(F.array(*shapes)))
    return urls.select(F.concat("shape.before", "name", "shape.after").alias("host"), F.col("shape.path").alias("path"), "block")


def judge(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """One row per page row: page_id, host, path, rule, verdict, block_score.

    `verdict` is the matched rule's, else block where the regression's score is 0.5 or more.
    A null url has empty host and path like one without ://. Repeated rows and null ids stay
    as they are; an empty table gives no rows; other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    urls = urls.withColumn("rule", rule).withColumn("_says", verdict)
    if labelled is None:
        labelled = urls.filter(F.col("_says").isNotNull()).withColumn("block", (F.col("_says") == "block").cast("double"))
    scored = train(labelled).score(urls)
    method = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("_says", method).alias("verdict"), "block_score")
