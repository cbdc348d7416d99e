"""Secret scans with multipart credential linking, in DataFrame functions only.

Each kind of part is a pattern whose leftmost non-overlapping matches are found in the whole text: a text's pieces
between the matches (split) and the matches (regexp_extract_all) give all offsets by a running sum. Three kinds are
reported wherever they pass their length: assign, access and hex. Three are weak, and only candidates:

  id        an account, client or user name, or a mail address
  key       a value given to a password-like name, short or not
  endpoint  a URL, or a host name: of a listed ending, or of any with a port (without one it may be a file or a call)

Names of weak parts begin where no letter or digit is before (monkey: is no key), and api_key is assign's alone. Values
run to their end, however long; host names have at most the 127 labels of 63 that DNS has.

A weak candidate is reported only if a complementary part lies in the same scope (the text between two blank lines)
and within reach code points of it: an id or endpoint needs a secret (assign, hex or key), a key needs an id, an
endpoint or an access identifier. A key in whose span a secret or access of the base kinds lies is not reported once
more. Each reported weak part names the nearest complement that it is linked to. This is an interval join on (document, scope) in which each candidate asks for the
nearest complement on either side: two window passes over the parts in order, so that the work and the rows grow with
the parts, never with their pairs.

Only lengths and kinds of parts leave the scan; no text is shuffled. Rows are dealt out by a row number of the scan,
so a document's parts meet in one task, and no column of the input decides how many of them do.

Defined cases: a null text is an empty one; a document without parts is one row with counts of zero; repeated rows,
and rows with equal or null doc_ids, are each a row of the result; of a complement before and one behind at the same
distance the one before is named, and of overlapping ones at either side the one that reaches farthest; a text of any
length is searched whole, by one task; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.operators.spread import spread

REACH = 200
MIN_ASSIGN_VALUE = 12
MIN_ACCESS = 18
MIN_HEX = 16

#: The base patterns. Offsets are code points, end exclusive.
_VALUE = "[A-Za-z0-9+/_.=-]+"
ASSIGN = rf"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?({_VALUE})"""
ACCESS = rf"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}"
HEX = rf"[0-9a-f]{{{MIN_HEX},}}"

_GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
ID = (
    rf"(?<![A-Za-z0-9])(?i:account(?:_?id)?|client_?id|access_?(?:key_?)?id|user(?:_?name)?|login){_GIVEN}[A-Za-z0-9+/_.@-]{{3,}}+"
    r"|[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,126}"
)
KEY = rf"(?<![A-Za-z0-9])(?i:passphrase|pwd|pass|auth|private_?key|credentials?|(?<!api_)key){_GIVEN}[A-Za-z0-9+/_.=-]{{6,}}+"
ENDPOINT = (
    r"(?i:https?|ftps?|s3|jdbc:[a-z]{1,16}|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x00-\x20\x22\x27<>]++"
    r"|(?<![A-Za-z0-9@.-])[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,126}"
    r"(?:\.(?:com|net|org|io|dev|local|internal)(?![A-Za-z0-9-])(?::[0-9]{1,5})?|\.[A-Za-z][A-Za-z0-9-]{1,62}:[0-9]{1,5}(?![0-9A-Za-z]))"
)
BREAK = r"\n[\x20\x09\x0D]*\n"

#: Kinds in their order among spans of the same start.
KINDS = ("assign", "access", "hex", "id", "key", "endpoint")
_BREAK_KIND = len(KINDS)
_PART = "struct<kind: int, place: int, gap: int, length: int, passed: boolean>"


def _pieces(kind: int, matches: Column, between: Column, passed=None) -> Column:
    """(kind, place, gap before, length, passed) of each match; gaps and lengths give the offsets."""
    return F.transform(
        matches,
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("place"),
            F.length(between[i]).alias("gap"),
            F.length(m).alias("length"),
            (F.lit(True) if passed is None else passed(i)).alias("passed"),
        ),
    )


def _parts(docs: DataFrame) -> DataFrame:
    """(row, doc_id, kind, place, gap, length, passed): a row a part; one with null kind for a document without any."""
    rows = spread(docs.select("doc_id", "text")).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    none = F.array().cast("array<string>")

    def found(pattern: str, where: Column | None = None) -> Column:
        every = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        return every if where is None else F.when(where, every).otherwise(none)

    def pieces(pattern: str, matches: str) -> Column:
        return F.when(F.size(matches) > 0, F.split("text", pattern, -1)).otherwise(none)

    rows = rows.select("*", found(ASSIGN).alias("assign"), found(ACCESS).alias("access"), found(HEX).alias("hex"), found(KEY).alias("key"))
    # without a secret, strong or weak, no identifier or endpoint can be reported, so none is looked for
    secret = F.size("assign") + F.size("hex") + F.size("key") > 0
    rows = rows.select("*", secret.alias("any_secret"))
    rows = rows.select("*", found(ID, F.col("any_secret")).alias("id"), found(ENDPOINT, F.col("any_secret")).alias("endpoint"))
    values = F.when(F.size("assign") > 0, F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))).otherwise(none)
    rows = rows.select("*", values.alias("assign_values"))
    # an assign of a short value is a weak key
    short = F.exists("assign_values", lambda v: F.length(v) < MIN_ASSIGN_VALUE)
    weak = (F.size("id") + F.size("endpoint") + F.size("key") > 0) | short
    rows = rows.select("*", weak.alias("weak")).select("*", found(BREAK, F.col("weak")).alias("break"))
    names = [*KINDS, "break"]
    patterns = dict(zip(names, (ASSIGN, ACCESS, HEX, ID, KEY, ENDPOINT, BREAK), strict=True))
    rows = rows.select("*", *(pieces(patterns[n], n).alias(f"{n}_gaps") for n in names))
    long_value = lambda i: F.length(F.col("assign_values")[i]) >= MIN_ASSIGN_VALUE
    lists = [
        _pieces(kind, F.col(n), F.col(f"{n}_gaps"), long_value if n == "assign" else None).cast(f"array<{_PART}>")
        for kind, n in enumerate(names)
    ]
    return rows.select("row", "doc_id", F.explode_outer(F.concat(*lists)).alias("part")).select("row", "doc_id", "part.*")


def secret_parts(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(row, doc_id, kind, start, end, base, reported, link): all parts and breaks; kind is null where there are none.

    link is the start, end and kind of the nearest complement of a weak part, null if there is none.
    """
    # dealt out by document once: both running sums and the result's groups keep this partitioning
    parts = _parts(docs).repartition("row")
    order = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("length")).over(order)
    parts = parts.select("row", "doc_id", "kind", "passed", (end - F.col("length")).alias("start"), end.alias("end"))
    # the base kinds are those that pass; an assign of a short value is a weak key
    kind = F.when((F.col("kind") == 0) & ~F.col("passed"), KINDS.index("key")).otherwise(F.col("kind"))
    parts = parts.withColumn("kind", kind)
    before = Window.partitionBy("row").orderBy("start", "kind", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scope = F.coalesce(F.sum((F.col("kind") == _BREAK_KIND).cast("long")).over(before), F.lit(0))
    parts = parts.withColumn("scope", scope)
    is_of = {"secret": F.col("kind").isin(0, 2, 4), "holder": F.col("kind").isin(1, 3, 5), "base": F.col("kind") <= 2}
    up = Window.partitionBy("row", "scope").orderBy("start", "kind", "end").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("row", "scope").orderBy(F.desc("start"), F.desc("kind"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({f"{n}_before": F.max(F.when(c, F.struct("end", "start", "kind"))).over(up) for n, c in is_of.items()})
    parts = parts.withColumns({f"{n}_after": F.min(F.when(c, F.struct("start", "end", "kind"))).over(down) for n, c in is_of.items()})

    def nearest(kind: str) -> Column:
        """The nearer of the complements before and behind, null if neither is within reach."""
        back, on = F.col(f"{kind}_before"), F.col(f"{kind}_after")
        gaps = [F.when(g.isNull(), reach + 1).when(g < 0, 0).otherwise(g) for g in (F.col("start") - back["end"], on["start"] - F.col("end"))]
        named = [F.struct(p["start"].alias("start"), p["end"].alias("end"), p["kind"].alias("kind")) for p in (back, on)]
        return F.when((gaps[0] <= reach) & (gaps[0] <= gaps[1]), named[0]).when(gaps[1] <= reach, named[1])

    overlaps = F.coalesce(F.col("base_before")["end"] > F.col("start"), F.lit(False)) | F.coalesce(F.col("base_after")["start"] < F.col("end"), F.lit(False))
    link = F.when(F.col("kind").isin(3, 5), nearest("secret")).when((F.col("kind") == 4) & ~overlaps, nearest("holder"))
    parts = parts.withColumn("link", link)
    base = is_of["base"]
    return parts.select("row", "doc_id", "kind", "start", "end", base.alias("base"), (base | F.col("link").isNotNull()).alias("reported"), "link")


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Per document: n_assign, n_access, n_hex, base_spans and spans, arrays of (start, end, kind) in order; and links, of

    the weak spans, each with the start, end and kind of the part that it is linked to.
    """
    parts = secret_parts(docs, reach)
    span = F.struct("start", F.col("kind").alias("rank"), "end")
    linked = F.struct("start", F.col("kind").alias("rank"), "end", F.col("link.start").alias("to_start"), F.col("link.end").alias("to_end"), F.col("link.kind").alias("to_rank"))
    base, reported = F.coalesce("base", F.lit(False)), F.coalesce("reported", F.lit(False))
    found = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        *(F.sum(F.when(F.col("kind") == i, 1).otherwise(0)).alias(f"n_{n}") for i, n in enumerate(KINDS[:3])),
        F.array_sort(F.collect_list(F.when(base, span))).alias("base_list"),
        F.array_sort(F.collect_list(F.when(reported, span))).alias("all_list"),
        F.array_sort(F.collect_list(F.when(F.col("link").isNotNull(), linked))).alias("link_list"),
    )
    kinds = F.array(*map(F.lit, KINDS))
    named = lambda c: F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), kinds[s["rank"]].alias("kind")))
    to = lambda s: F.struct(s["to_start"].alias("start"), s["to_end"].alias("end"), kinds[s["to_rank"]].alias("kind"))
    links = F.transform("link_list", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), kinds[s["rank"]].alias("kind"), to(s).alias("to")))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", named("base_list").alias("base_spans"), named("all_list").alias("spans"), links.alias("links"))


def secret_digests(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, of kind:start:end in order, comma-joined; and links, each of
    a weak span, > and the span that it is linked to."""
    found = find_secrets(docs, reach)
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    joined = lambda c: F.array_join(F.transform(c, text), ",")
    links = F.array_join(F.transform("links", lambda s: F.concat_ws(">", text(s), text(s["to"]))), ",")
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"), links.alias("links")
    )
