"""URL verdicts by rules and by the reputation of hosts, shrunk through their domains and suffixes."""

from __future__ import annotations

from dataclasses import dataclass
from math import asin, pi, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelabel.llm.common import LOWER, UPPER, small_enough, stored

# Fixed values: (rule, verdict) of the contract.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
# Labels under which country domains register names; with the country's two letters
# behind them they are a public suffix.
SECOND_LEVEL = (
    "ac", "asn", "asso", "biz", "co", "com", "edu", "firm", "gen", "go", "gob", "gouv", "gov", "govt", "gv", "id", "ind",
    "info", "int", "ltd", "med", "mil", "muni", "ne", "net", "nhs", "nic", "nom", "or", "org", "plc", "police", "pro",
    "res", "sch", "school", "web",
)


@dataclass(frozen=True)
class ReputationParams:
    """A host is blocked if its share of bad pages exceeds `limit` with a posterior probability of
    at least `sure`. The prior strength of each level is estimated and kept within (`weakest`,
    `strongest`) pages. `suffixes` are further public suffixes, of hosting services for example."""

    limit: float = 0.5
    sure: float = 0.95
    weakest: float = 1.0
    strongest: float = 10_000.0
    suffixes: tuple[str, ...] = ()


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def site_of(host: Column) -> Column:
    """The host alone: without user, port and a last dot."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"(:[0-9]*)?\.?$|\.:[0-9]*$", "")


def registered_domain(site: Column, suffixes: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """Registered domain and public suffix; addresses and sites of one label are both.

    The suffix is the last label, or the last two where a country's domain is registered under a
    second level, or one of `suffixes`; the domain has one label more.
    """
    labels = F.split(site, r"\.")
    size = F.size(labels)

    def last(n: int) -> Column:
        return F.array_join(F.slice(labels, F.greatest(size - n + 1, F.lit(1)), F.lit(n)), ".")

    parts = F.lit(1)
    second = F.element_at(labels, F.when(size > 1, -2).otherwise(-1))
    national = (F.length(F.element_at(labels, -1)) == 2) & second.isin(*SECOND_LEVEL)
    parts = F.when(national & (size > 2), 2).otherwise(parts)
    for own in sorted(suffixes, key=len):
        parts = F.when(F.endswith(site, F.lit("." + own)), len(own.split("."))).otherwise(parts)
    longest = max([2, *(len(s.split(".")) for s in suffixes)])
    address = F.rlike(site, F.lit(r"^\[|^[0-9]+(\.[0-9]+){3}$"))
    domain, suffix = site, site
    for n in range(1, longest + 1):
        domain = F.when((parts == n) & ~address, last(n + 1)).otherwise(domain)
        suffix = F.when((parts == n) & ~address, last(n)).otherwise(suffix)
    return domain, suffix


def _rule(rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict. A short list: one CASE."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, what in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, slash, rest = rule.partition("/")
        fits = ((F.col("host") == own) | F.endswith(F.col("host"), F.lit("." + own))) & F.startswith(F.col("path"), F.lit(slash + rest))
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def _strength(level: DataFrame, params: ReputationParams) -> float:
    """Pages that the prior of a level is worth, by moments of (k, n, prior): one row reaches the driver.

    If the level's members all had their parent's rate, squared deviations of k would add up to the
    binomial variance; what is beyond gives the correlation rho inside members.
    """
    base = F.col("prior") * (1 - F.col("prior"))
    row = level.agg(
        F.sum((F.col("k") - F.col("n") * F.col("prior")) ** 2).alias("seen"), F.sum(F.col("n") * base).alias("plain"),
        F.sum(F.col("n") * (F.col("n") - 1) * base).alias("pairs")).first()
    if not row["pairs"]:
        return params.strongest
    rho = (row["seen"] - row["plain"]) / row["pairs"]
    return min(max(1 / rho - 1, params.weakest), params.strongest) if rho > 0 else params.strongest


def _shrunk(level: DataFrame, strength: float) -> Column:
    return (F.col("k") + strength * F.col("prior")) / (F.col("n") + strength)


#: Cells of the integral in `chance_above`.
CELLS = 400


def chance_above(limit: float, a: Column, b: Column) -> Column:
    """Probability that a beta variable with parameters `a` and `b` lies above `limit`.

    With x the squared sine of an angle, its density is smooth and of nearly the same width
    everywhere; it is added up over cells within eight deviations of the mean, the cell with the
    limit in it in part.
    """
    mean = F.asin(F.sqrt(a / (a + b)))
    reach = 4 / F.sqrt(a + b + 1)
    low, high = F.greatest(mean - reach, F.lit(0.0)), F.least(mean + reach, F.lit(pi / 2))
    width = (high - low) / CELLS
    edge = asin(sqrt(limit))

    def log_density(angle: Column) -> Column:
        return (2 * a - 1) * F.log(F.sin(angle)) + (2 * b - 1) * F.log(F.cos(angle))

    def add(done: Column, i: Column) -> Column:
        begin = low + i * width
        density = F.exp(log_density(begin + width / 2) - log_density(F.greatest(F.least(mean, F.lit(1.55)), F.lit(0.02))))
        above = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (begin + width - edge) / width))
        return F.struct((done["all"] + density).alias("all"), (done["above"] + density * above).alias("above"))

    start = F.struct(F.lit(0.0).alias("all"), F.lit(0.0).alias("above"))
    cells = F.sequence(F.lit(0), F.lit(CELLS - 1))
    return F.aggregate(cells, start, add, lambda done: done["above"] / done["all"])


def reputations(outcomes: DataFrame, params: ReputationParams = ReputationParams()) -> DataFrame:
    """(host, n, k, bad_rate, above) from (host, bad) of labelled pages; `above` is the posterior
    probability that the host's rate exceeds the limit, or null where the mean rules it out.

    Counts go from hosts to domains to suffixes, so pages are read once and a hot host is added up
    before the shuffle. Each level's posterior mean is the prior mean of the level below.
    """
    domain, suffix = registered_domain(F.col("host"), params.suffixes)
    hosts = stored(outcomes.groupBy("host").agg(F.sum("bad").cast("double").alias("k"), F.count("bad").cast("double").alias("n"))
                   .withColumns({"domain": domain, "suffix": suffix}))
    domains = stored(hosts.groupBy("domain", "suffix").agg(F.sum("k").alias("k"), F.sum("n").alias("n")))
    suffixes = domains.groupBy("suffix").agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
    total = hosts.agg(F.sum("k").alias("k"), F.sum("n").alias("n")).first()
    mean = (total["k"] or 0.0) / total["n"] if total["n"] else 0.0

    level = stored(suffixes.withColumn("prior", F.lit(mean)))
    means = level.select("suffix", _shrunk(level, _strength(level, params)).alias("prior"))
    level = stored(domains.join(means, "suffix"))
    means = level.select("domain", "suffix", _shrunk(level, _strength(level, params)).alias("prior"))
    level = stored(hosts.join(means, ["domain", "suffix"]))
    strength = _strength(level, params)
    rate = _shrunk(level, strength)
    good = F.col("n") - F.col("k") + strength * (1 - F.col("prior"))
    # If most of a distribution lies above the limit, so does nearly its mean: few need the integral.
    above = F.when(rate > params.sure * params.limit, F.when(good <= 0, 1.0).otherwise(
        chance_above(params.limit, F.col("k") + strength * F.col("prior"), good)))
    return stored(level.select("host", "n", "k", rate.alias("bad_rate"), above.alias("above")))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: tuple[tuple[str, str], ...] = RULES,
    params: ReputationParams = ReputationParams(), id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    `outcomes` has (page_id, bad 0 or 1) of labelled pages; rows with nulls do not count, and an id
    on several pages counts for each. A page that no rule fits is blocked if its host's share of bad
    pages is above the limit with the asked posterior probability, else allowed; hosts without
    labelled pages are allowed. For reputations a host counts without user, port and last dot. A null
    url, or one without `://`, has an empty host and path; very long ones are taken whole. Equally long rules: the larger string
    wins. Rows that repeat an id are judged one by one. An empty table gives no rows; other columns
    are ignored.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url"))
    host, path = host_and_path(F.col("_url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    known = outcomes.where("page_id is not null and bad is not null").select("page_id", "bad")
    site = site_of(F.col("host"))
    labelled = rows.where("page_id is not null").select("page_id", site.alias("host")).join(known, "page_id").select("host", "bad")
    bad = reputations(labelled, params).where(F.col("above") >= params.sure)
    blocked = stored(bad.select(F.col("host").alias("_site"), F.lit(True).alias("low")))
    name, verdict = _rule(rules)
    judged = rows.withColumns({"rule": name, "_rule": verdict, "_site": site})
    joined = judged.join(F.broadcast(blocked) if small_enough(blocked) else blocked, "_site", "left")
    by_host = F.when(F.col("low"), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("_rule", by_host).alias("verdict"))
