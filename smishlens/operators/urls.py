"""URL reputation tokens (inventory C2, E1).

The reference asks a reputation service once per distinct URL. Here the
service is a ``threats(url, threat_type)`` table and the lookup is a join:

1. every URL occurrence becomes a narrow row ``(id, pos, url)`` (``posexplode``);
2. the rows are left-joined to the suspicious URL set, which is broadcast when it is counted
   to be small; otherwise only URLs that are not frequent shuffle (see ``operators.skew``);
3. flags are regrouped per message (partial aggregation first, so one row per
   message crosses the shuffle) and the text is rebuilt from the pieces between
   the URLs with ``zip_with``.

A message is identified by its id and a hash of its text, and its flags are a set:
rows that share an id keep their own flags, and equal rows share theirs.
Messages without a URL never enter the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smishlens.functions import text as T
from smishlens.operators.reputation import listed_urls
from smishlens.operators.skew import lookup_join

# Threat types that make a URL suspicious.
SUSPICIOUS_TYPES = ("MALWARE", "SOCIAL_ENGINEERING")


def suspicious_urls(threats: DataFrame) -> DataFrame:
    """Distinct URLs listed with one of the counted threat types."""
    return (threats.filter(F.col("threat_type").isin(*SUSPICIOUS_TYPES))
            .select("url").distinct())


def _rebuild(text_col: str, flags_col: str):
    pieces = T.split_on_urls(F.col(text_col))
    tokens = F.transform(F.col(flags_col), lambda f: F.when(f["bad"], F.lit(T.URL_SUSPICIOUS_TOKEN))
                         .otherwise(F.lit(T.URL_TRUSTED_TOKEN)))
    tail = F.slice(pieces, 2, F.size(pieces) - 1)
    return F.concat(F.element_at(pieces, 1),
                    F.array_join(F.zip_with(tokens, tail, lambda t, g: F.concat(t, g)), ""))


def tokenise_urls(df: DataFrame, threats: DataFrame | None, text_col: str = "message",
                  id_col: str = "msg_id", out_col: str | None = None) -> DataFrame:
    """Replace each URL by ' URL_SUSPICIOUS ' or ' URL_TRUSTED '. ``threats`` lists whole URLs ``(url, threat_type)`` or
    ``(expression, threat_type)`` as a reputation service does (see ``operators.reputation``)."""
    out_col = out_col or text_col
    if threats is None:
        # Nothing can be suspicious: a single regexp_replace, no join.
        replaced = F.regexp_replace(F.col(text_col), T.URL_PATTERN, T.URL_TRUSTED_TOKEN)
        return df.withColumn(out_col, F.when(T.may_have_url(F.col(text_col)), replaced).otherwise(F.col(text_col)))
    text = F.col(text_col)
    # Cheap substring test first: the URL regex only runs on candidates (the
    # optimizer pushes these filters down to the scan).
    has_url = F.coalesce(T.may_have_url(text) & (F.size(T.extract_urls(text)) > 0), F.lit(False))
    plain = df.filter(~has_url).withColumn(out_col, text)
    with_urls = df.filter(has_url).withColumn("_urls", T.extract_urls(text))
    with_urls = with_urls.withColumn("_text_key", F.xxhash64(text))
    occurrences = with_urls.select(id_col, "_text_key", F.posexplode("_urls").alias("_pos", "url"))
    if "expression" in threats.columns:  # a list of hosts and path prefixes
        bad = listed_urls(occurrences, threats.filter(F.col("threat_type").isin(*SUSPICIOUS_TYPES))).select("url").distinct()
    else:
        bad = suspicious_urls(threats)
    bad = bad.select(F.col("url").alias("_listed"), F.lit(True).alias("_bad"))
    flags = (lookup_join(occurrences, bad, "url", "_listed")
             .groupBy(id_col, "_text_key")
             .agg(F.array_sort(F.collect_set(F.struct(
                 F.col("_pos").alias("pos"),
                 F.coalesce(F.col("_bad"), F.lit(False)).alias("bad")))).alias("_flags")))
    own = with_urls.drop("_urls")
    flags = flags.withColumnsRenamed({id_col: "_flags_id", "_text_key": "_flags_key"})
    rebuilt = (own.join(flags, own[id_col].eqNullSafe(flags["_flags_id"]) & (own["_text_key"] == flags["_flags_key"]))
               .withColumn(out_col, _rebuild(text_col, "_flags"))
               .drop("_flags", "_flags_id", "_flags_key", "_text_key"))
    return plain.unionByName(rebuilt)
