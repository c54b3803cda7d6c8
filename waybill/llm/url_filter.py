"""URL verdicts: host rules first, else an empirical-Bayes reputation of the host.

Labelled page outcomes are counted per host, once; domains and suffixes are sums of hosts. Each level's bad rate is
shrunk by a beta-binomial prior centred on the level above (suffix: the global rate), whose weight is estimated at
every level by moments around those centres. A host is blocked where the lower 5 % quantile of its beta posterior lies
above a threshold, that is where the posterior gives the rates up to the threshold less than 5 %.
All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged

#: (rule, verdict): a host, then a path prefix.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
#: Suffixes of two labels, under which a registered domain has three.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "com.br", "co.nz", "co.in", "com.mx")
#: Normal score of the posterior's share below the threshold under which a host is blocked (5 %).
Z = -1.6448536269514722
#: The bad rate that a host must surely pass, 0.01 at least. Lower ones block more, as 0.2, near the rate of all pages.
THRESHOLD = 0.5
MIN_WEIGHT, MAX_WEIGHT = 1.0, 1000.0
#: Hosts up to this number (about 100 bytes each) are broadcast to the pages; beyond, a salted join.
MAX_BROADCAST_HOSTS = 200_000
SALTS = 16


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): both empty for null or where there is no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return _lower_ascii(host), path


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host without user and port; an address of digits is its own domain."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    numeric = bare.rlike(r"^[0-9.]+$")
    two = F.substring_index(bare, ".", -2)
    long = two.isin(*TWO_LABEL_SUFFIXES)
    suffix = F.when(numeric, "").when(long, two).otherwise(F.substring_index(bare, ".", -1))
    return F.when(numeric, bare).when(long, F.substring_index(bare, ".", -3)).otherwise(two), suffix


def rule_of(host: Column, path: Column, rules=None) -> tuple[Column, Column]:
    """The longest rule that fits a URL, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(RULES if rules is None else rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, _, rest = text.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(f"/{rest}"))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _weight(level: DataFrame, centre: str) -> float:
    """Prior weight of a level from its groups' counts ``n, bad`` and ``centre``: moments of the beta-binomial.

    A group's squared distance from its centre m, times n, is m (1 - m) (1 + (n - 1) / (weight + 1)) on average.
    """
    m = F.col(centre)
    row = level.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - m, F.lit(2.0))),
        F.sum(m * (1 - m)), F.sum((F.col("n") - 1) * m * (1 - m)),
    ).first()
    seen, least, room = (x or 0.0 for x in row)
    if room <= 0 or seen <= least:
        return MAX_WEIGHT
    return min(MAX_WEIGHT, max(MIN_WEIGHT, room / (seen - least) - 1))


def _tilt(x: Column) -> Column:
    """(1 - x^2 + 2 x ln x) / (1 - x)^2, which is (1 - x) / 3 near 1 and 1 at 0."""
    whole = (1 - x * x + 2 * x * F.ln(x)) / F.pow(1 - x, F.lit(2.0))
    return F.when(F.abs(x - 1) < 1e-4, (1 - x) / 3).otherwise(whole)


def share_below(a: Column, b: Column, x: float) -> Column:
    """Normal score of the share of a beta distribution's mass below ``x``, by Peizer and Pratt's closed form.

    Off by less than 0.005 of the mass for parameters of 1 and more. Null, meaning no small share, where ``a`` is 0.5 or
    less, as most of the mass is at 0; a ``b`` below 0.51 counts as 0.51, which gives no smaller share.
    """
    b = F.greatest(b, F.lit(0.51))
    n, s, t, y = a + b - 1, a - 0.5, b - 0.5, 1 - x
    shift = t - (n + 1 / 3) * y + 1 / 6 + 0.02 * (x / b - y / a + (x - 0.5) / (a + b))
    spread = (1 + x * _tilt(t / (n * y)) + y * _tilt(s / (n * x))) / ((n + 1 / 6) * x * y)
    return F.when(a > 0.5, shift * F.sqrt(spread))


def host_counts(outcomes: DataFrame) -> DataFrame:
    """``host, domain, suffix, n, bad`` from one row per page with ``host`` and ``bad`` (0, 1 or null: not labelled)."""
    domain, suffix = domain_and_suffix(F.col("host"))
    count = [F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")]
    return outcomes.where("host is not null").groupBy("host").agg(*count).withColumns({"domain": domain, "suffix": suffix})


def reputations(hosts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``host, n, bad, rate, below`` of every host of ``host_counts``; ``below`` is the score of ``share_below``.

    A host without labelled pages has the rate of its domain, a domain without any that of its suffix, a suffix without
    any the global rate, each with the spread of its level. Without any outcome the rate is 0.5 everywhere. An empty
    table gives an empty result.
    """
    total = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*total)
    suffixes = hosts.groupBy("suffix").agg(*total)
    n, bad = hosts.agg(F.sum("n"), F.sum("bad")).first()
    rate = (bad + 0.5) / (n + 1.0) if n else 0.5

    def shrunk(level: DataFrame, centre: str) -> tuple[DataFrame, float]:
        weight = _weight(level, centre)
        return level.withColumn("rate", (F.col("bad") + F.col(centre) * F.lit(weight)) / (F.col("n") + F.lit(weight))), weight

    suffixes, _ = shrunk(suffixes.withColumn("above", F.lit(rate)), "above")
    domains, _ = shrunk(domains.join(suffixes.select("suffix", F.col("rate").alias("above")), "suffix"), "above")
    rated, weight = shrunk(hosts.join(domains.select("domain", "suffix", F.col("rate").alias("above")), ["domain", "suffix"]), "above")
    mass = F.col("n") + F.lit(weight)
    return rated.select("host", "n", "bad", "rate", share_below(F.col("rate") * mass, (1 - F.col("rate")) * mass, threshold).alias("below"))


def filter_urls(spark: SparkSession, pages: DataFrame, outcomes: DataFrame, rules=None, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict, rate, below`` for every row of ``pages`` (``page_id``, ``url``).

    ``outcomes`` has ``page_id`` and ``bad`` (0, 1 or null); an id that repeats counts once, as bad if any of its
    rows is, and a page that repeats counts each time. A null id has no outcome. A url that is null or has no ``://`` has
    an empty host; it is judged like the other pages of that host. Of rules that fit, the longest wins; equally long
    ones of two hosts cannot both fit, and of equal rules the last one counts. A ``below`` equal to the limit allows.
    Hosts without labelled pages are judged by the levels above; without any outcome every page is allowed. An empty
    table gives an empty result. Other columns are not read. Pages meet their outcomes in one join, and one written
    table of hosts feeds all levels.
    """
    host, path = url_parts(F.col("url"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    marks = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    hosts = staged(spark, host_counts(urls.select("page_id", "host").join(marks, "page_id", "left")), "hosts")
    rated = reputations(hosts, threshold).select("host", "rate", "below")
    urls = urls.withColumns({"rule": rule, "_says": says})
    if hosts.count() <= MAX_BROADCAST_HOSTS:
        judged = urls.join(F.broadcast(rated), "host", "left")
    else:
        salt = F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS))
        copies = rated.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        judged = urls.withColumn("_salt", salt).join(copies, ["host", "_salt"], "left")
    own = F.when(F.coalesce(F.col("below") < F.lit(Z), F.lit(False)), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("_says", own).alias("verdict"), "rate", "below")


def labelled_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, bad`` from the labels of the documents with the pages' ids: of low quality or toxic is bad."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    return labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every page, and the rate behind the method's; odd rows and empty tables: see ``filter_urls``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    judged = filter_urls(spark, pages, labelled_outcomes(spark, sf_dir))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("rate", 6).alias("bad_rate"))


_OP2_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN coalesce(instr(url, '://'), 0) > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM urls
), marks AS (
  SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id
), named AS (
  SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM (SELECT DISTINCT host FROM urls)
), places AS (
  SELECT host, string_split(bare, '.') AS p, bare, regexp_full_match(bare, '[0-9.]+') AS numeric,
         array_to_string(list_slice(string_split(bare, '.'), greatest(len(string_split(bare, '.')) - 1, 1), len(string_split(bare, '.'))), '.') AS two
  FROM named
), sites AS (
  SELECT host, CASE WHEN numeric THEN bare
      WHEN two IN ('co.uk','org.uk','ac.uk','com.au','net.au','co.jp','com.br','co.nz','co.in','com.mx')
      THEN array_to_string(list_slice(p, greatest(len(p) - 2, 1), len(p)), '.') ELSE two END AS domain,
    CASE WHEN numeric THEN ''
      WHEN two IN ('co.uk','org.uk','ac.uk','com.au','net.au','co.jp','com.br','co.nz','co.in','com.mx') THEN two ELSE p[len(p)] END AS suffix
  FROM places
), hosts AS (
  SELECT u.host, domain, suffix, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad
  FROM urls u LEFT JOIN marks m ON u.page_id = m.page_id JOIN sites s ON s.host = u.host GROUP BY ALL
), overall AS (SELECT CASE WHEN sum(n) > 0 THEN (sum(bad) + 0.5) / (sum(n) + 1.0) ELSE 0.5 END AS c FROM hosts
), s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(c) AS c FROM hosts, overall GROUP BY suffix
), s1 AS (SELECT {weight} AS w FROM s0 WHERE n > 0
), s2 AS (SELECT suffix, (bad + c * w) / (n + w) AS r FROM s0, s1
), d0 AS (SELECT domain, h.suffix, sum(n) AS n, sum(bad) AS bad, any_value(r) AS c FROM hosts h JOIN s2 ON h.suffix = s2.suffix GROUP BY domain, h.suffix
), d1 AS (SELECT {weight} AS w FROM d0 WHERE n > 0
), d2 AS (SELECT domain, suffix, (bad + c * w) / (n + w) AS r FROM d0, d1
), h0 AS (SELECT host, n, bad, r AS c FROM hosts h JOIN d2 ON h.domain = d2.domain AND h.suffix = d2.suffix
), h1 AS (SELECT {weight} AS w FROM h0 WHERE n > 0
), h2 AS (SELECT host, (bad + c * w) / (n + w) AS r, n + w AS m FROM h0, h1
), p0 AS (SELECT host, r, r * m AS a, greatest((1 - r) * m, 0.51) AS b, {x} AS x FROM h2
), p1 AS (SELECT *, (b - 0.5) / ((a + b - 1) * (1 - x)) AS g, (a - 0.5) / ((a + b - 1) * x) AS h FROM p0 WHERE a > 0.5
), p2 AS (
  SELECT host, (b - 0.5 - (a + b - 1 + 1.0 / 3) * (1 - x) + 1.0 / 6 + 0.02 * (x / b - (1 - x) / a + (x - 0.5) / (a + b)))
    * sqrt((1 + x * CASE WHEN abs(g - 1) < 1e-4 THEN (1 - g) / 3 ELSE (1 - g * g + 2 * g * ln(g)) / pow(1 - g, 2) END
      + (1 - x) * CASE WHEN abs(h - 1) < 1e-4 THEN (1 - h) / 3 ELSE (1 - h * h + 2 * h * ln(h)) / pow(1 - h, 2) END)
      / ((a + b - 1 + 1.0 / 6) * x * (1 - x))) AS z FROM p1
)
SELECT page_id, u.host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN z < -1.6448536269514722 THEN 'block' ELSE 'allow' END AS verdict,
  round(r, 6) AS bad_rate
FROM ruled u LEFT JOIN p0 ON u.host = p0.host LEFT JOIN p2 ON u.host = p2.host
"""
#: The SQL twin of ``op2_url_filter`` for a threshold; {weight} is the moment estimate of a level's prior weight.
_WEIGHT_SQL = (
    "coalesce(CASE WHEN sum((n - 1) * c * (1 - c)) <= 0 OR sum(n * pow(bad / n - c, 2)) <= sum(c * (1 - c)) THEN 1000.0 "
    "ELSE least(1000.0, greatest(1.0, sum((n - 1) * c * (1 - c)) / (sum(n * pow(bad / n - c, 2)) - sum(c * (1 - c))) - 1)) END, 1000.0)"
)


def sql_of(threshold: float = THRESHOLD) -> str:
    return _OP2_SQL.replace("{weight}", _WEIGHT_SQL).replace("{x}", f"{threshold}::DOUBLE")


OP2_SQL = sql_of()
