"""Secrets in texts, and weak candidates that count only beside the other parts of a credential.

Three strong kinds are reported wherever they occur: ``assign`` (a secret's name with a value),
``access`` (access identifiers) and ``hex`` (long hexadecimal runs).  Four weak kinds say little
alone: ``id`` (a named account or key id), ``endpoint`` (a URL or named host), ``part`` (a vaguely
named value) and ``blob`` (a long mixed run of letters and digits).  Every kind plays a role in a
credential: identifier, secret or endpoint.  A weak candidate is reported only if a complementary
part lies within ``REACH`` code points of it in the same scope (a run of text without a blank
line): a secret needs an identifier or an endpoint, these two need a secret.

All of it is SQL functions and joins.  Matches and the pieces between them come from the same
pattern, so running sums of their lengths are the positions.  Candidates and parts meet in an
interval join: both are dealt to the buckets of ``BUCKET`` code points that they reach, and the
join is on (text, scope, bucket) with the distance as residual.  A bucket holds at most as many
parts as fit its width, so a text full of candidates gives a bounded number of pairs for each of
its characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.scratch import stage

REACH, BUCKET = 200, 512
#: A text's parts are summed in runs of so many, and then over runs.
_RUN = 128

#: The patterns of the strong kinds, in the order in which they are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters or more
HEX = r"[0-9a-f]{24,}"

ID = r"""(?i:user_?(?:name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]{3,})"""
ENDPOINT = r"""(?i:https?|s?ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[^\x00-\x20"'<>]+|(?i:host(?:name)?|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{3,}"""
PART = r"""(?i:pass|pwd|passphrase|private_?key|auth|credential|signature)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})"""
BLOB = r"[A-Za-z0-9+/]{32,}={0,2}"
SCOPE = r"\n[\x20\x09\x0D]*\n"

#: Kind, pattern, group whose value counts, its least length, role; strong kinds first.
KINDS = (
    ("assign", ASSIGN, 1, 6, "secret"), ("access", ACCESS, 0, 20, "identifier"), ("hex", HEX, 0, 24, "secret"),
    ("id", ID, 1, 3, "identifier"), ("endpoint", ENDPOINT, 0, 1, "endpoint"), ("part", PART, 1, 6, "secret"), ("blob", BLOB, 0, 32, "secret"),
)
STRONG = 3
_SPAN = "array<struct<start:bigint,kind:int,stop:bigint>>"


def running(sizes: Column) -> Column:
    """For each element of an array of longs the sum of those before it."""
    def within(run: Column) -> Column:
        begin = F.struct(F.expr("cast(array() as array<bigint>)").alias("sums"), F.lit(0).cast("long").alias("total"))
        step = lambda acc, x: F.struct(F.concat(acc["sums"], F.array(acc["total"])).alias("sums"), (acc["total"] + x).alias("total"))
        return F.aggregate(run, begin, step, lambda acc: acc["sums"])

    def summed(sizes: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _RUN).cast("int")), lambda k: F.slice(sizes, k * _RUN + 1, F.lit(_RUN)))
        total = lambda run: F.aggregate(run, F.lit(0).cast("long"), lambda acc, x: acc + x)
        return _let(runs, lambda runs: F.flatten(F.zip_with(runs, within(F.transform(runs, total)), lambda run, base: F.transform(within(run), lambda x: x + base))))

    return F.when(F.size(sizes) > 0, _let(sizes, summed)).otherwise(F.expr("cast(array() as array<bigint>)"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often, and inside whatever lambda, the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _spans(table: DataFrame, name: str, pattern: str, group: int, least: int, number: int) -> DataFrame:
    """Add a column with the spans of a pattern in ``text``: structs of start, kind number and stop, in code points."""
    found, values, pieces, sizes, at = (f"{name}_{x}" for x in ("found", "values", "pieces", "sizes", "at"))
    has = F.col("text").rlike(pattern)
    none = F.expr("cast(array() as array<string>)")
    table = table.withColumns({
        found: F.when(has, F.regexp_extract_all("text", F.lit(pattern), 0)).otherwise(none),
        values: F.when(has, F.regexp_extract_all("text", F.lit(pattern), group)).otherwise(none) if group else F.lit(None),
        pieces: F.when(has, F.split("text", pattern, -1)).otherwise(none),
    })
    table = table.withColumn(sizes, F.transform(F.arrays_zip(F.col(found).alias("m"), F.col(values if group else found).alias("v"), F.slice(pieces, 1, F.size(found)).alias("p")),
                                                lambda x: F.struct(F.length(x["p"]).cast("long").alias("gap"), F.length(x["m"]).cast("long").alias("size"), F.length(x["v"]).alias("value"))))
    table = table.withColumn(at, running(F.transform(sizes, lambda x: x["gap"] + x["size"])))
    spans = F.zip_with(sizes, at, lambda x, before: F.struct((before + x["gap"]).alias("start"), F.lit(number).alias("kind"), (before + x["gap"] + x["size"]).alias("stop"), x["value"].alias("value")))
    spans = F.transform(F.filter(spans, lambda s: s["value"] >= least), lambda s: F.struct(s["start"], s["kind"], s["stop"]))
    return table.withColumn(name, spans.cast(_SPAN)).drop(found, values, pieces, sizes, at)


def _listed(spans: Column) -> Column:
    """kind:start:stop of spans, comma-joined, by start and then kind."""
    names = F.array(*(F.lit(k[0]) for k in KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def parts(docs: DataFrame) -> DataFrame:
    """One narrow row per text, staged: row (a number of its own), doc_id, the spans of each strong kind, and all parts with their scope."""
    names = [k[0] for k in KINDS]
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id())
    for number, (name, pattern, group, least, _) in enumerate(KINDS):
        table = _spans(table, name, pattern, group, least, number)
    some = F.size(F.concat(*names[STRONG:])) > 0
    table = _spans(table.withColumn("text", F.when(some, F.col("text")).otherwise("")), "scope", SCOPE, 0, 1, -1)  # scopes serve weak candidates only
    table = table.drop("text").withColumn("all", F.when(some, F.array_sort(F.concat("scope", *names))).otherwise(F.expr(f"cast(array() as {_SPAN})")))
    table = table.withColumn("scopes", running(F.transform("all", lambda s: F.when(s["kind"] < 0, 1).otherwise(0).cast("long"))))
    found = F.filter(F.zip_with("all", "scopes", lambda s, n: F.struct(s["start"], s["kind"], s["stop"], n.alias("scope"))), lambda s: s["kind"] >= 0)
    return stage(table.select("row", "doc_id", *names[:STRONG], found.alias("parts")), "credential-parts")


def linked(found: DataFrame) -> DataFrame:
    """The weak candidates of ``parts`` that have a complementary part within reach in their scope and lie on no strong span: (row, kind, start, stop)."""
    roles = F.array(*(F.lit(k[4]) for k in KINDS))
    flat = found.select("row", F.explode("parts").alias("s")).select("row", "s.scope", "s.kind", "s.start", "s.stop").withColumn("role", F.element_at(roles, F.col("kind") + 1))
    bucket = lambda column: F.floor(column / BUCKET).cast("long")
    weak = flat.filter(F.col("kind") >= STRONG).withColumn("bucket", F.explode(F.sequence(bucket(F.greatest(F.lit(0), F.col("start") - REACH)), bucket(F.col("stop") + REACH))))
    near = flat.withColumn("bucket", F.explode(F.sequence(bucket(F.col("start")), bucket(F.col("stop") - 1))))
    near = near.select("row", "scope", "bucket", F.col("kind").alias("by"), F.col("start").alias("low"), F.col("stop").alias("high"), F.col("role").alias("as"))
    reach = (F.col("low") <= F.col("stop") + REACH) & (F.col("high") >= F.col("start") - REACH)
    apart = (F.col("low") >= F.col("stop")) | (F.col("high") <= F.col("start"))
    complementary = F.when(F.col("role") == "secret", F.col("as") != "secret").otherwise(F.col("as") == "secret") & apart
    covered = (F.col("by") < STRONG) & ~apart
    pairs = weak.join(near, ["row", "scope", "bucket"]).filter(reach & (complementary | covered))
    return pairs.groupBy("row", "kind", "start", "stop").agg(F.bool_or(complementary).alias("near"), F.bool_or(covered).alias("covered")).filter("near and not covered").select("row", "kind", "start", "stop")


def secrets(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    ``docs`` has doc_id and text; other columns are ignored, whatever their names.  Spans are
    ``kind:start:stop`` in code points, the stop exclusive, by start and then kind (strong kinds
    first); ``base_sha256`` is the digest of the strong ones, which are always reported, and
    ``spans`` lists these and the linked weak ones.  A null or empty text has none (an empty list
    and its digest).  Rows repeating a doc_id, or with a null one, are documents of their own; an
    empty table gives no rows.
    """
    found = parts(docs)
    names = [k[0] for k in KINDS[:STRONG]]
    weak = linked(found).groupBy("row").agg(F.collect_list(F.struct("start", "kind", "stop")).cast(_SPAN).alias("weak"))  # of one text
    strong = F.concat(*names)
    out = found.drop("parts").join(weak, "row", "left")
    return out.select(
        "doc_id", *(F.size(n).cast("long").alias(f"n_{n}") for n in names), F.sha2(_listed(strong).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat(strong, F.coalesce("weak", F.expr(f"cast(array() as {_SPAN})")))).alias("spans"),
    )
