"""URL verdicts by rules, propagated over redirect and canonical-link edges.

A url's own longest rule decides it.  Without one, the connected component of
the url over its alias edges does: an explicitly allowed member allows, else a
blocked member blocks, else ``allow``.

Edges: the redirects that sites answer to other spellings of an address
(scheme, ``www.`` and ``m.`` hosts, fragment, tracking parameters, ``.html``,
trailing slash), and what a page says itself (``<link rel=canonical>``,
``<meta http-equiv=refresh>``: all of them, character references decoded,
resolved against the page's ``<base>`` or url).

Defined cases: a null url, or one without ``://``, has an empty host and path,
no rule, no edges and the verdict ``allow``; repeated rows are judged alike;
an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genrec.llm.common import free_name, let, materialise
from genrec.llm.graph import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host and its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | F.endswith(host, F.lit("." + self.host))) & F.startswith(path, F.lit(self.path))


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))

CANONICAL = (r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?\s*([^"'\s>]+)""")
REFRESH = (r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?\s*([^"'\s>]+)""")
BASE = r"""(?is)<base\b[^>]*\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
REFERENCE = r"^&(?:#([0-9]{1,7})|#[xX]([0-9a-fA-F]{1,6})|(amp|lt|gt|quot|apos));"
URL_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(.*)$"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _by_rule(rules: tuple[Rule, ...], host: Column, path: Column, value: str) -> Column:
    """``value`` of the longest fitting rule, else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        out = F.when(r.fits(host, path), F.lit(getattr(r, value))).otherwise(out)
    return out


def address(url: Column) -> Column:
    """The address that a site's usual redirects lead to; null for no address."""
    host = F.regexp_replace(host_of(url), r"^(?:(?:www|m)\.)+(?=[^.]+\.)", "")
    path = F.regexp_replace(path_of(url), r"(?:/index)?(?:\.html?)?/*$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(r"^(?:utm_[a-z]+|ref|fbclid|gclid)(?:=|$)")), "&")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))))


def decoded(value: Column) -> Column:
    """``value`` with its numeric and its five basic named character references replaced."""
    named = F.create_map(*(F.lit(x) for x in ("amp", "&", "lt", "<", "gt", ">", "quot", '"', "apos", "'")))

    def char(part: Column) -> Column:
        decimal, hexed, name = (F.regexp_extract(part, REFERENCE, k) for k in (1, 2, 3))
        code = F.when(decimal != "", decimal.cast("int")).when(hexed != "", F.conv(hexed, 16, 10).cast("int"))
        return F.when(name != "", named[name]).otherwise(let(code, lambda c: F.when(
            c.between(1, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32"))))

    parts = F.transform(F.split(value, "(?=&)"), lambda x: F.coalesce(
        F.concat(char(x), F.regexp_replace(x, REFERENCE, "")), x))
    return F.when(F.contains(value, F.lit("&")), F.array_join(parts, "")).otherwise(value)


def _parts(url: Column) -> Column:
    return F.struct(*(F.regexp_extract(url, URL_PARTS, k).alias(n) for k, n in enumerate(("scheme", "host", "path", "tail"), 1)))


def _without_dots(path: Column) -> Column:
    """``path``, which starts with a slash, without ``.`` and ``..`` segments."""
    steps = F.split(path, "/", -1)
    kept = F.aggregate(F.slice(steps, 2, F.size(steps)), F.array().cast("array<string>"), lambda a, x: F.when(x == ".", a).when(
        x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.array_append(a, x)))
    end = F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.regexp_replace(
        F.concat(F.lit("/"), F.array_join(kept, "/"), end), "^/+$", "/")).otherwise(path)


def resolved(target: Column, base: Column) -> Column:
    """The url that ``target`` means on a page whose base is ``base``; null where it is no address
    (``mailto:``, a base without ``://``)."""
    def whole(t: Column, b: Column) -> Column:
        site = F.concat(b["scheme"], F.lit("://"), b["host"])
        folder = F.regexp_extract(F.when(b["path"] == "", F.lit("/")).otherwise(b["path"]), "^.*/", 0)
        relative = F.when(b["scheme"] != "", F.when(F.startswith(t, F.lit("//")), F.concat(b["scheme"], F.lit(":"), t)).when(
            F.startswith(t, F.lit("/")), F.concat(site, t)).when(
            F.startswith(t, F.lit("?")), F.concat(site, b["path"], t)).when(
            (t == "") | F.startswith(t, F.lit("#")), F.concat(site, b["path"], F.regexp_extract(b["tail"], r"^[^#]*", 0), t)).otherwise(
            F.concat(site, folder, t)))
        return F.when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.when(t.rlike(URL_PARTS), t)).otherwise(relative)

    return let(target, lambda t: let(_parts(base), lambda b: let(whole(t, b), lambda w: let(_parts(w), lambda p: F.when(
        p["scheme"] != "", F.concat(p["scheme"], F.lit("://"), p["host"], _without_dots(p["path"]), p["tail"]))))))


def alias_edges(pages: DataFrame) -> DataFrame:
    """``a, b``: urls and addresses that lead to one another.  Addresses hold no
    ``://``, so they never equal a url."""
    url = F.col("url")
    own = address(url)
    said = F.concat(*(F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in (CANONICAL, REFRESH)))
    speaking = pages.where(F.contains(F.lower("html"), F.lit("canonical")) | F.contains(F.lower("html"), F.lit("refresh")))
    told = speaking.select("url", own.alias("a"), F.regexp_extract("html", BASE, 1).alias("base"), F.explode(said).alias("b"))
    base = F.coalesce(F.when(F.col("base") != "", resolved(decoded(F.col("base")), url)), url)
    told = told.select("a", base.alias("base"), decoded(F.col("b")).alias("b"))
    links = told.select("a", resolved(F.col("b"), F.col("base")).alias("b")).where(host_of(F.col("b")) != "")
    spelled = links.select(F.col("b").alias("a"), address(F.col("b")).alias("b"))
    return pages.select(url.alias("a"), own.alias("b")).unionAll(links).unionAll(spelled).where(
        "a is not null and b is not null")


def _judged(pages: DataFrame, rules: tuple[Rule, ...]) -> tuple[DataFrame, str]:
    """``pages`` and a struct of host, path, rule, verdict and component, with its name."""
    found_by, key, v = (free_name(pages, x) for x in ("url_judged", "url_node", "url_seed"))
    url = F.col("url")
    host, path = host_of(url), path_of(url)
    ruled = pages.withColumn(found_by, F.struct(host.alias("host"), path.alias("path")))
    at = F.col(f"{found_by}.host"), F.col(f"{found_by}.path")
    ruled = ruled.withColumn(found_by, F.struct(
        at[0].alias("host"), at[1].alias("path"), _by_rule(rules, *at, "name").alias("rule"),
        _by_rule(rules, *at, "verdict").alias("own")))
    edges = materialise(alias_edges(pages).distinct(), "url-edges")
    found = components(edges, "url-components").withColumnRenamed("node", key)
    # every url decides its component, crawled or only pointed to; addresses hold no "://"
    urls = edges.select(F.explode(F.array("a", "b")).alias(key)).where(F.contains(key, F.lit("://"))).distinct()
    seeds = urls.withColumn(v, _by_rule(rules, host_of(F.col(key)), path_of(F.col(key)), "verdict")).where(F.col(v).isNotNull())
    of_component = seeds.join(found, key).groupBy("component").agg(
        F.when(F.bool_or(F.col(v) == "allow"), "allow").otherwise("block").alias("inherited"))
    by_url = found.join(of_component, "component", "left").select(key, F.struct("component", "inherited").alias(v))
    rows = ruled.join(by_url, url == F.col(key), "left")
    verdict = F.coalesce(f"{found_by}.own", f"{v}.inherited", F.lit("allow"))
    return rows.withColumn(found_by, F.struct(
        f"{found_by}.host", f"{found_by}.path", f"{found_by}.rule", verdict.alias("verdict"),
        f"{v}.component")).drop(key, v), found_by


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, component`` of every row.  Runs the
    rounds of the component search."""
    rows, c = _judged(pages, rules)
    return rows.select("page_id", f"{c}.*")


def allowed(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``pages``, with its columns, whose verdict is ``allow``."""
    rows, c = _judged(pages, rules)
    return rows.where(F.col(f"{c}.verdict") == "allow").select(*(F.col(f"`{x}`") for x in pages.columns))
