"""Secret scan with a ledger of what has been scanned.

Every text is addressed by the SHA-256 of its bytes. The ledger holds one row per
(blob, rule, version) ever scanned, with the spans found, also when there are none.
A run scans only the pairs of blob and rule version that the ledger lacks, one text
per blob however many paths hold it, and joins the findings of all its blobs back to
every path.

Spans are code points, end exclusive. A rule's matches are leftmost and do not overlap;
those whose value is too short are dropped after matching. Built-in functions give
matches and the pieces between them but no positions, so positions are running sums
over the lengths of pieces and matches.

Defined cases: null text is scanned as empty and has no spans; repeated rows and ties of
the path each get the findings; an empty table gives an empty result; other columns of
the input are ignored or kept by the caller.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from depotline.llm.registry import documents, query
from depotline.session import store


@dataclass(frozen=True)
class Rule:
    """``probe`` holds wherever the rule has a span, and is cheap or a pattern that decides early."""

    kind: str
    version: int
    pattern: str
    probe: str
    value_group: int = 0
    least: int = 1


# The rules, in the order in which spans of equal start are listed.
RULES = [
    Rule(
        "assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}""", 2, 6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{16}", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", r"[0-9a-f]{24}", 0, 24),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8}"),
    Rule("url", 1, r"[a-z][a-z0-9+]{1,20}://[^\s:/@]{1,100}:[^\s:/@]{1,100}@", r"://[^\s:/@]{1,100}:[^\s:/@]{1,100}@"),
]
BASE_KINDS = ["assign", "access", "hex"]

SPANS = "array<struct<start:bigint,end:bigint>>"


#: Elements of a block, in folds over long arrays.
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def prefixes(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """What ``combine`` makes of zero and all elements before each element of an array of longs.

    A fold that appends copies its array at every step, so it runs over blocks, and once more over their results;
    what is copied grows with the length and a 256th of its square.
    """
    zero = F.array(F.lit(0).cast("bigint"))

    def fold(part: Column) -> Column:
        return F.aggregate(part, zero, lambda done, x: F.array_append(done, combine(F.element_at(done, -1), x)))

    def shifted(blocks: Column, before: Column) -> Column:
        return F.flatten(F.transform(blocks, lambda own, i: F.transform(F.slice(own, F.lit(1), F.size(own) - 1), lambda x: combine(F.get(before, i), x))))

    def blockwise(all_values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_values) - 1) / BLOCK).cast("int"))
        blocks = F.transform(numbers, lambda n: fold(F.slice(all_values, n * BLOCK + 1, F.lit(BLOCK))))
        return let(blocks, lambda own: let(fold(F.transform(own, lambda x: F.element_at(x, -1))), lambda before: shifted(own, before)))

    return F.when(F.size(values) == 0, F.array().cast("array<bigint>")).otherwise(let(values, blockwise))


def rule_spans(text: Column, rule: Rule) -> Column:
    """Spans of the rule's matches in ``text`` whose value is long enough."""
    pattern = F.lit(rule.pattern)
    pieces, matches = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.value_group))
    lengths = F.transform(
        F.arrays_zip(pieces.alias("piece"), matches.alias("match"), values.alias("value")),
        # The last piece has no match behind it.
        lambda p: F.struct(
            F.length(p["piece"]).cast("bigint").alias("piece"), F.coalesce(F.length(p["match"]), F.lit(0)).cast("bigint").alias("match"), (F.length(p["value"]) >= rule.least).alias("kept")
        ),
    )

    def located(parts: Column) -> Column:
        before = prefixes(F.transform(parts, lambda p: p["piece"] + p["match"]), lambda x, y: x + y)
        placed = let(before, lambda at: F.transform(parts, lambda p, i: F.struct(
            (F.get(at, i) + p["piece"]).alias("start"), (F.get(at, i) + p["piece"] + p["match"]).alias("end"), p["kept"].alias("kept")
        )))
        return F.transform(F.filter(placed, lambda p: p["kept"]), lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))

    return F.when(text.rlike(rule.probe), let(lengths, located)).otherwise(F.array().cast(SPANS))


def address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """Ledger rows (blob, rule, version, spans) for the pairs that ``ledger`` lacks.

    ``versions`` has columns ``path`` and ``text``, one row per path and version of it.
    The text is shuffled once, by path and blob together, so that a blob that a third
    of all paths hold is no hot key.
    """
    versions = versions.select("path", F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", address(F.col("text")))
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    todo = versions.groupBy("blob").agg(F.min("path").alias("path")).withColumn("unseen", wanted)
    if ledger is not None:
        # At most one row per rule and blob comes together again.
        pairs = todo.select("blob", "path", F.explode("unseen").alias("pair")).select("blob", "path", "pair.*")
        todo = (
            pairs.join(ledger.select("blob", "rule", "version"), ["blob", "rule", "version"], "left_anti")
            .groupBy("blob", "path").agg(F.collect_list(F.struct("rule", "version")).alias("unseen"))
        )
    todo = todo.select(F.col("blob").alias("todo_blob"), F.col("path").alias("todo_path"), "unseen")
    texts = versions.join(todo.hint("shuffle_hash"), versions["path"].eqNullSafe(todo["todo_path"]) & (versions["blob"] == todo["todo_blob"]))
    results = F.array(*[
        F.when(
            F.array_contains(F.transform("unseen", lambda p: p["rule"]), r.kind),
            F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), rule_spans(F.col("text"), r).alias("spans")),
        )
        for r in rules
    ])
    found = texts.select("blob", F.explode(F.filter(results, lambda r: r.isNotNull())).alias("row")).select("blob", "row.*")
    return found.dropDuplicates(["blob", "rule", "version"])


def findings(ledger: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``blob`` and ``spans`` (start, place, kind, end) in reading order, of blobs that have any under these rules."""
    place = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (f"{r.kind}:{r.version}", i)])
    known = F.concat_ws(":", "rule", "version")
    spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), place[known].alias("place"), F.col("rule").alias("kind"), s["end"].alias("end")))
    return (
        ledger.where((F.size("spans") > 0) & place[known].isNotNull())
        .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list(spans))).alias("spans"))
    )


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: list[Rule] = RULES) -> tuple[DataFrame, DataFrame]:
    """Every path with its ``blob`` and ``spans`` (empty if clean), and the ledger rows this run added (stored)."""
    added = store(scan_unseen(versions, ledger, rules), "secret-ledger")
    whole = added if ledger is None else ledger.select(added.columns).unionByName(added)
    paths = versions.select("path", address(F.col("text")).alias("blob"))
    empty = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
    found = paths.join(findings(whole, rules), "blob", "left").select("path", "blob", F.coalesce("spans", empty).alias("spans"))
    return found, added


#: Largest size of findings that are sent to all texts instead of dealing texts and findings by blob.
BROADCAST_BYTES = 64 << 20


def masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with every span replaced; spans (start, ..., end) are in order and may overlap.

    What stays before a span begins where all earlier ones end. A substring counts code points from the start of its
    text, so pieces are cut from the part of the text that a block of spans covers.
    """

    def cut(own: Column, ends: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(own) - 1) / BLOCK).cast("int"))

        def block(n: Column) -> Column:
            first = n * BLOCK
            base = F.get(ends, first)
            last = F.least(first + BLOCK, F.size(own)) - 1
            return let(F.substring(text, (base + 1).cast("int"), F.greatest(F.get(own, last)["start"] - base, F.lit(0)).cast("int")), lambda part: F.array_join(F.transform(
                F.slice(own, first + 1, F.lit(BLOCK)),
                lambda s, i: F.concat(
                    F.substring(part, (F.get(ends, first + i) - base + 1).cast("int"), F.greatest(s["start"] - F.get(ends, first + i), F.lit(0)).cast("int")),
                    F.when(s["start"] >= F.get(ends, first + i), F.lit(mask)).otherwise(F.lit("")),
                ),
            ), ""))

        tail = F.substring(text, (F.array_max(F.transform(own, lambda s: s["end"])) + 1).cast("int"), 2**31 - 1)
        return F.concat(F.array_join(F.transform(numbers, block), ""), tail)

    reached = prefixes(F.transform(spans, lambda s: s["end"].cast("bigint")), F.greatest)
    return F.when(F.size(spans) == 0, text).otherwise(let(reached, lambda ends: cut(spans, ends)))


def redact(docs: DataFrame, ledger: DataFrame | None = None, mask: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced and ``n_chars`` following; clean rows as they were.

    Overlapping spans of different kinds are masked once. Rows travel as one column, so their names can't clash.
    """
    versions = docs.select(F.col("doc_id").alias("path"), "text")
    _, added = scan(versions, ledger)
    whole = added if ledger is None else ledger.select(added.columns).unionByName(added)
    found = store(findings(whole), "secret-findings")
    size = found.agg(F.sum(64 + 48 * F.size("spans"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        found = F.broadcast(found)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), address(F.col("text")).alias("blob"))
    joined = rows.join(found, "blob", "left").withColumn("clean", F.col("spans").isNull())
    text = F.when(F.col("clean"), F.col("record.text")).otherwise(masked(F.col("record.text"), F.col("spans"), mask))
    changed = joined.withColumn("masked", text)
    count = F.when(F.col("clean"), F.col("record.n_chars")).otherwise(F.length("masked").cast("long")) if "n_chars" in docs.columns else None
    new = {"text": F.col("masked"), "n_chars": count}
    return changed.select(*[(new[c] if c in new else F.col(f"record.`{c}`")).alias(c) for c in docs.columns])


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")



def _check_sql() -> str:
    """The same spans from pieces and matches of each rule, over every text and without a ledger."""
    found = " UNION ALL ".join(
        f"""SELECT doc_id, '{r.kind}' AS kind, {i} AS place, start, start + length(match) AS stop FROM (
              SELECT doc_id, unnest(matches) AS match, unnest(vals) AS val, unnest(list_transform(range(1, len(matches) + 1),
                       lambda i: coalesce(list_sum(list_transform(pieces[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: length(x))), 0))) AS start
              FROM (SELECT doc_id, regexp_split_to_array(t, {p}) AS pieces, regexp_extract_all(t, {p}, 0) AS matches, regexp_extract_all(t, {p}, {r.value_group}) AS vals FROM d))
            WHERE length(val) >= {r.least}"""
        for i, r in enumerate(RULES)
        for p in ["'" + r.pattern.replace("'", "''") + "'"]
    )
    base = ", ".join(f"'{kind}'" for kind in BASE_KINDS)
    counts = ", ".join(f"count(kind) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind in BASE_KINDS)
    order = "',' ORDER BY start, place"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
      s AS (SELECT *, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM ({found}))
      SELECT d.doc_id, {counts}, sha256(coalesce(string_agg(span, {order}) FILTER (WHERE kind IN ({base})), '')) AS base_sha256,
             coalesce(string_agg(span, {order}), '') AS spans
      FROM d LEFT JOIN s ON d.doc_id = s.doc_id GROUP BY d.doc_id"""


@query("op9_secret_scans", _check_sql())
def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = documents(spark, sf_dir).select(F.col("doc_id").alias("path"), "text")
    found, _ = scan(versions)
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(BASE_KINDS))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("path").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )
