"""Not-modified revisits of a crawl resolved against the latest earlier full response of the same canonical URL.

Captures are rows (record_id, url, ts, kind, etag, last_modified, digest, headers); kind is `response` or `revisit`, ts whole
seconds, headers an array of (name, value). For every revisit the as-of join finds the full response with the greatest ts
below its own (of equal ones the greatest record_id), compares the first validator that both have (entity tag without
weakness mark, last modification, payload digest), and merges the headers: those of the response, updated by the revisit's,
but for the ones that describe the stored payload or the connection (RFC 9111, 3.2).

The join is a running maximum over (url, hour) with the last response before the hour carried in from a summary of the hours,
so captures of one URL are spread over tasks by time and only the summary has a URL's hours in one place.

Verdicts: resolved, mismatch (the validator differs), unchecked (no common validator) and orphan (no earlier response).
Defined results: null urls share one canonical URL, the empty one; captures without ts are orphans, and as responses never
earlier than others; null headers count as none; repeated rows are resolved each; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHUNK = 3600
# Fields of a stored response that a 304 must not update, and fields of one connection.
KEPT_FIELDS = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
               "proxy-authenticate", "proxy-authentication-info", "te", "trailer", "transfer-encoding", "upgrade")
TRACKING = r"^(utm_[^=]*|gclid|fbclid|ref)(=|$)"


def canonical(url: Column) -> Column:
    """Host in lower case without www, m and default port; path without a closing slash; query sorted, without tracking;
    neither scheme nor fragment."""
    plain = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), r"^[a-zA-Z][a-zA-Z0-9+.-]*://|#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(plain, r"^[^/?]*", 0)), r"^(www\d*|m)\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(plain, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    asked = F.regexp_extract(plain, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """Headers of the stored response with the permitted ones of the revisit in place of those of the same name."""
    none = F.array().cast("array<struct<name:string,value:string>>")

    def lowered(headers: Column) -> Column:
        return F.transform(F.coalesce(headers, none), lambda h: F.struct(F.lower(h["name"]).alias("name"), h["value"].alias("value")))

    update = F.filter(lowered(fresh), lambda h: ~h["name"].isin(*KEPT_FIELDS))
    names = F.transform(update, lambda h: h["name"])
    return F.array_sort(F.concat(F.filter(lowered(stored), lambda h: ~F.array_contains(names, h["name"])), update))


def resolved(captures: DataFrame) -> DataFrame:
    """record_id, url, ts, verdict, refers_to, digest and headers of every revisit."""
    rows = captures.select("record_id", canonical(F.col("url")).alias("url"), F.col("ts").cast("long").alias("ts"), "kind", "etag",
                           "last_modified", "digest", "headers")
    rows = rows.withColumn("chunk", F.floor(F.col("ts") / CHUNK))
    response = F.when((F.col("kind") == "response") & F.col("ts").isNotNull(),
                      F.struct("ts", "record_id", "etag", "last_modified", "digest", "headers"))
    hours = rows.where("ts is not null").groupBy("url", "chunk").agg(F.max(response).alias("last"))
    before = Window.partitionBy("url").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = hours.select("url", "chunk", F.max("last").over(before).alias("carried"))
    joined = rows.join(carried, ["url", "chunk"], "left")
    within = Window.partitionBy("url", "chunk").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    found = F.when(F.col("ts").isNotNull(), F.coalesce(F.max(response).over(within), F.col("carried")))
    found = joined.select("*", found.alias("r")).where(F.col("kind") == "revisit")

    def tag(c: Column) -> Column:
        return F.regexp_replace(c, "^W/", "")

    pairs = ((tag(F.col("etag")), tag(F.col("r.etag"))), (F.col("last_modified"), F.col("r.last_modified")),
             (F.col("digest"), F.col("r.digest")))
    same = F.coalesce(*[mine == theirs for mine, theirs in pairs])  # null where either side has none
    verdict = (F.when(F.col("r").isNull(), "orphan").when(same.isNull(), "unchecked").when(same, "resolved").otherwise("mismatch"))
    good = verdict == "resolved"
    return found.select("record_id", "url", "ts", verdict.alias("verdict"), F.when(good, F.col("r.record_id")).alias("refers_to"),
                        F.when(good, F.col("r.digest")).alias("digest"),
                        F.when(good, merged_headers(F.col("r.headers"), F.col("headers"))).alias("headers"))


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl history that Spark derives from pages: each page fetched, and asked for again three or four times.

    A third of the pages change once, a third answer with a stale entity tag once, a third with a date alone; every tenth
    is first asked for before it was ever stored.
    """
    def header(name: str, value: Column | str) -> Column:
        return F.struct(F.lit(name).alias("name"), (F.lit(value) if isinstance(value, str) else value).alias("value"))

    def capture(n: int, days: int, kind: str, etag: Column, modified: Column, digest: Column, headers: list[Column]) -> Column:
        return F.struct((F.col("page_id") * 8 + n).alias("record_id"), (F.lit(days * 86_400) + F.col("page_id") % 86_400).alias("ts"),
                        F.lit(kind).alias("kind"), etag.alias("etag"), modified.alias("last_modified"), digest.alias("digest"),
                        F.array(*headers).alias("headers"))

    none = F.lit(None).cast("string")
    old, new = F.md5(F.coalesce("html", F.lit(""))), F.md5(F.concat(F.coalesce("html", F.lit("")), F.lit("<!-- 2 -->")))
    third = F.col("page_id") % 3
    length = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    full = [header("Content-Type", "text/html"), header("Content-Length", length), header("Date", "day 10"),
            header("Cache-Control", "max-age=60"), header("Set-Cookie", "a=1")]
    fresh = [header("Date", "day 40"), header("cache-control", "max-age=600"), header("Content-Length", "0"), header("X-Cache", "hit")]
    stored = capture(1, 10, "response", F.concat(F.lit('"'), old, F.lit('"')), F.lit("day 9"), old, full)
    asked = capture(2, 40, "revisit", F.concat(F.lit('W/"'), old, F.lit('"')), none, none, fresh)
    changed = capture(3, 70, "response", F.concat(F.lit('"'), new, F.lit('"')), F.lit("day 69"), new, full)
    stale = capture(3, 70, "revisit", F.lit('"stale"'), F.lit("day 9"), none, fresh)
    dated = capture(3, 70, "revisit", none, F.lit("day 9"), none, [header("Expires", "never")])
    again = capture(4, 100, "revisit", none, none, F.when(third == 0, new).otherwise(old), fresh)
    bare = capture(5, 110, "revisit", none, none, none, fresh)
    early = capture(0, 5, "revisit", F.concat(F.lit('"'), old, F.lit('"')), none, none, fresh)
    rows = F.array(F.when(F.col("page_id") % 10 == 0, early), stored, asked,
                   F.when(third == 0, changed).when(third == 1, stale).otherwise(dated), again, F.when(F.col("page_id") % 7 == 0, bare))
    return pages.select("url", F.explode(F.filter(rows, lambda c: c.isNotNull())).alias("c")).select("url", "c.*")
