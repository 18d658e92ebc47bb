"""URL reputation by expressions (inventory E1).

A reputation list names hosts and path prefixes, not only whole URLs. A URL is brought
into canonical form and gives up to thirty expressions: its host and up to four suffixes of
it (of the last five labels, never the last alone), each with the whole path and query, the
path, and up to four of its leading folders. It is listed when one of its expressions is.

Expressions are looked up as such services do it: by the first 32 bits of their SHA-256, a
join on an integer, and then by the whole digest of what the join has found. Only distinct URLs
are expanded, only distinct expressions meet the list, and a common host is one row there.

All of it is Column expressions. Bytes that are no UTF-8 after unescaping count as U+FFFD.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labels of a host suffix, most suffixes, and most folders of a path.
SUFFIX_LABELS = 5
SUFFIXES = 4
FOLDERS = 4

_ESCAPE = "%[0-9a-fA-F]{2}"
#: One part of a numeric host: hexadecimal, octal, decimal.
_NUMBER = "(0[xX][0-9a-fA-F]+|[0-9]+)"


def unescape(text: Column) -> Column:
    """Percent escapes undone until none is left; a percent sign that starts none stays."""
    def once(s: Column) -> Column:
        # the decoder takes a plus for a blank and stops at a stray percent sign
        safe = F.regexp_replace(F.regexp_replace(s, "%(?![0-9a-fA-F]{2})", "%25"), r"\+", "%2B")
        return F.try_url_decode(safe)

    rounds = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text)))
    undone = F.aggregate(rounds, text, lambda s, _: F.when(s.rlike(_ESCAPE), F.coalesce(once(s), s)).otherwise(s))
    return F.when(text.rlike(_ESCAPE), undone).otherwise(text)


def escape(text: Column) -> Column:
    """Blanks, control characters, ``#``, ``%`` and all beyond ASCII as upper-case percent escapes."""
    def one(c: Column) -> Column:
        escaped = F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")
        return F.when(c.rlike(r"[\x00-\x20#%\x7F]|[^\x00-\x7F]"), escaped).otherwise(c)

    return F.when(text.rlike(r"[\x00-\x20#%\x7F]|[^\x00-\x7F]"), F.array_join(F.transform(F.split(text, ""), one), "")).otherwise(text)


def _number(part: Column) -> Column:
    """The value of a numeric host part."""
    return F.when(part.rlike("^0[xX]"), F.conv(F.substring(part, 3, 100), 16, 10)) \
        .when(part.rlike("^0[0-7]+$"), F.conv(part, 8, 10)).otherwise(part).cast("decimal(20,0)")


def _address(host: Column) -> Column:
    """A numeric host as four decimal parts; null for other hosts and numbers out of range."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    numbers = F.transform(parts, _number)
    rest = F.element_at(numbers, -1).cast("long")
    lead = F.slice(numbers, 1, n - 1)
    left = F.lit(5) - n  # bytes of the last part
    powers = F.array(*[F.lit(256 ** k).cast("long") for k in range(5)])
    fits = F.forall(lead, lambda x: x < 256) & (rest < F.get(powers, left))
    last = F.transform(F.sequence(F.lit(1), left), lambda k: F.pmod(
        F.floor(rest / F.get(powers, left - k)), F.lit(256)).cast("long").cast("string"))
    whole = F.array_join(F.concat(F.transform(lead, lambda x: x.cast("string")), last), ".")
    return F.when(host.rlike(rf"^{_NUMBER}(\.{_NUMBER}){{0,3}}$"), F.when(fits, whole))


def _path(path: Column) -> Column:
    """Without empty, ``.`` and ``..`` segments; a closing slash stays."""
    segments = F.split(path, "/")
    walked = F.aggregate(segments, F.array().cast("array<string>"), lambda acc, s: F.when(s.isin("", "."), acc).when(
        s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(s))))
    joined = F.concat(F.lit("/"), F.array_join(walked, "/"))
    folder = F.element_at(segments, -1).isin("", ".", "..") & (F.size(walked) > 0)
    return F.when(folder, F.concat(joined, F.lit("/"))).otherwise(joined)


def with_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with ``_host``, ``_path`` and ``_query`` (null without one) of the canonical form."""
    plain = F.regexp_replace(F.trim(F.regexp_replace(F.col(url), r"[\t\r\n]", "")), "#.*$", "")
    step = urls.withColumn("_u", unescape(plain)).withColumn("_u", F.regexp_replace("_u", "^[a-zA-Z][a-zA-Z0-9+.-]*://", ""))
    step = step.withColumns({"_authority": F.regexp_extract("_u", "^([^/?]*)", 1), "_rest": F.regexp_extract("_u", r"(?s)^[^/?]*(.*)$", 1)})
    host = F.regexp_replace(F.regexp_replace("_authority", "^.*@", ""), ":[0-9]*$", "")
    host = F.lower(F.regexp_replace(F.regexp_replace(host, r"^\.+|\.+$", ""), r"\.{2,}", "."))
    step = step.withColumn("_host", host)
    step = step.withColumns({"_host": escape(F.coalesce(_address(F.col("_host")), F.col("_host"))),
                             "_path": escape(_path(F.regexp_extract("_rest", r"(?s)^([^?]*)", 1))),
                             "_query": F.when(F.col("_rest").contains("?"), escape(F.regexp_extract("_rest", r"(?s)^[^?]*\?(.*)$", 1)))})
    return step.drop("_u", "_authority", "_rest")


def expressions(host: Column, path: Column, query: Column) -> Column:
    """The array of a canonical URL's expressions, each once."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    is_address = host.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    first = F.greatest(F.lit(2), n - SUFFIX_LABELS + 1)  # the first label of the longest suffix
    count = F.when(is_address, 0).otherwise(F.least(F.lit(SUFFIXES), n - first))
    suffixes = F.when(count > 0, F.transform(F.sequence(first, first + count - 1), lambda k: F.array_join(F.slice(labels, k, n), "."))) \
        .otherwise(F.array().cast("array<string>"))
    hosts = F.concat(F.array(host), suffixes)
    folders = F.filter(F.split(F.regexp_replace(path, "[^/]*$", ""), "/"), lambda s: s != "")
    # "/", "/a/", "/a/b/", ..
    prefixes = F.transform(F.sequence(F.lit(0), F.least(F.lit(FOLDERS - 1), F.size(folders))), lambda k: F.concat(
        F.lit("/"), F.array_join(F.transform(F.slice(folders, 1, k), lambda s: F.concat(s, F.lit("/"))), "")))
    paths = F.concat(F.array(path), prefixes, F.when(query.isNotNull(), F.array(F.concat(path, F.lit("?"), query)))
                     .otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p)))))


def digest_prefix(digest: Column) -> Column:
    """The first 32 bits of a hexadecimal digest, as a long."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def listed_urls(urls: DataFrame, listed: DataFrame, url: str = "url") -> DataFrame:
    """``(url, threat_type)`` of the distinct URLs of which an expression is in ``listed`` (expression, threat_type)."""
    own = with_parts(urls.select(F.col(url).alias("url")).filter("url is not null").distinct())
    own = own.select("url", F.explode(expressions(F.col("_host"), F.col("_path"), F.col("_query"))).alias("expression"))
    names = listed.select("threat_type", F.sha2("expression", 256).alias("listed_digest")).distinct()
    names = names.withColumn("prefix", digest_prefix(F.col("listed_digest")))
    distinct = own.select("expression").distinct().withColumn("digest", F.sha2("expression", 256)) \
        .withColumn("prefix", digest_prefix(F.col("digest")))
    hits = distinct.join(names, "prefix").filter(F.col("digest") == F.col("listed_digest")).select("expression", "threat_type")
    return own.join(hits, "expression").select("url", "threat_type").distinct()
