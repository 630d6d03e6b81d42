"""Conversation structure repair: the cheapest edits to alternating turns, on conversations of any length.

Rows are sorted by conversation and turn over ranges of partitions, so one
conversation may lie in several. A task reads its range in order. A conversation
that lies whole in it is repaired there; the first and the last of a range, and
those longer than ``max_rows`` messages or ``max_bytes``, leave as segments.
Segments become elements (see ``hirschberg``), which are composed up a tree of
1024 children a node; going down again, each node gives its children their entry
and exit states, and every segment is rebuilt by itself. A conversation of any
size thus needs no task that holds it. Only its digest is one sequential job by
definition: one task streams the repaired text and holds the hash state.

Faults of a row, the first of them counts: blank (no visible character),
duplicate (role and text seen earlier in the conversation), cut off (the last
visible character is none of ``.!?``). Blank and duplicate rows are deleted.

Nulls: a null role or text is one space (a blank text; a role that fits
nowhere); a null turn sorts first; rows with a null conversation are one
conversation. An empty role fits nowhere either. Rows of one conversation and
turn are taken by role and text, so equal rows stand side by side and order does
not depend on partitions. Other columns are not read, whatever their names. An
empty table gives an empty table; a conversation without rows has no audit.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import hirschberg as hb
from tidemark.llm.common import cut, drop, map_arrow, partitions_for

MAX_ROWS = 1024
MAX_BYTES = 1 << 20
FAN_OUT = 1024
LEGAL = {"su", "ua", "au"}
VISIBLE = re.compile("[^\\x20\\x09-\\x0D]")
COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
BUILT = (
    "conv_id {conv}, at long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired string, "
    "roles array<string>, texts array<string>"
)


def rows_of(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text of each row, without nulls in the last two."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))


def damage(rows: DataFrame, parts: int = 20) -> DataFrame:
    """The rows of ``rows_of`` with faults put in by the crc32 of ``conv_id:turn``."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % parts
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).cast("int")))
    return rows.filter(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")


def faults(roles: list[str], texts: list[str], repeated: set[int]) -> tuple[str, dict[str, int]]:
    """(class of each message, counts of faults); ``repeated``: places of rows seen earlier."""
    kinds, counts = [], dict.fromkeys(COUNTS, 0)
    for i, (role, text) in enumerate(zip(roles, texts, strict=True)):
        seen = VISIBLE.search(text[::-1])
        blank, twice = seen is None, i in repeated
        cut_off = not blank and not twice and seen.group() not in ".!?"
        counts["blank"] += blank
        counts["duplicate"] += twice and not blank
        counts["truncated"] += cut_off
        counts["illegal"] += i > 0 and roles[i - 1][:1] + role[:1] not in LEGAL
        kinds.append(hb.message_class(role[:1], blank or twice, cut_off))
    return "".join(kinds), counts


def lines(messages: list[tuple[str, str]]) -> str | None:
    return "\n".join(f"{role}:{text}" for role, text in messages) if messages else None


def _whole(roles: list[str], texts: list[str]) -> dict:
    """Counts, audit and repaired text of a conversation held whole."""
    seen, repeated = set(), set()
    for i, message in enumerate(zip(roles, texts, strict=True)):
        if message in seen:
            repeated.add(i)
        seen.add(message)
    kinds, counts = faults(roles, texts, repeated)
    cost, letters, states = hb.solve(kinds + hb.END)
    return counts | {"cost": cost, "audit": "".join(letters), "repaired": lines(hb.repaired(roles, texts, letters, states)) or ""}


def build(rows: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Repaired conversations (with an audit), and segments (with roles and texts) of the others, numbered in order by ``at``."""
    kind = rows.schema["conv_id"].dataType
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    dealt = rows.repartitionByRange(partitions_for(rows.sparkSession), *order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    layout = rows.sparkSession.createDataFrame([], BUILT.format(conv=kind.simpleString())).schema

    def run(batches):
        arrow = _arrow_schema(batches_of := iter(batches))
        if arrow is None:
            return
        first_batch, conv_type = arrow
        number = TaskContext.get().partitionId() << 33
        out: list[dict] = []
        held: list[tuple[str, str]] = []
        size, conv, pieces, began = 0, None, 0, False

        def segment():
            nonlocal number, held, size, pieces
            out.append({"conv_id": conv, "at": number, "roles": [r for r, _ in held], "texts": [t for _, t in held]})
            number, held, size, pieces = number + 1, [], 0, pieces + 1

        def close(last: bool):
            nonlocal held, size
            if pieces or last or conv_number == 0:
                segment()
            else:
                out.append({"conv_id": conv} | _whole([r for r, _ in held], [t for _, t in held]))
                held, size = [], 0

        def record():
            rows_out, out[:] = list(out), []
            return pa.RecordBatch.from_pylist(rows_out, schema=_built_schema(conv_type))

        conv_number = 0
        for batch in _chain(first_batch, batches_of):
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
                if began and c != conv:
                    close(False)
                    conv_number, pieces = conv_number + 1, 0
                elif held and (len(held) >= max_rows or size >= max_bytes):
                    segment()
                began, conv = True, c
                held.append((role, text))
                size += len(text)
                if len(out) >= 512 or sum(len(x) for _, x in held) > max_bytes and len(out) > 8:
                    yield record()
        if began:
            close(True)
        if out:
            yield record()

    return map_arrow(dealt, run, layout)


def _arrow_schema(batches):
    """The first batch and its type of conversations, or None without rows."""
    first = next(batches, None)
    return None if first is None else (first, first.schema.field("conv_id").type)


def _chain(first, rest):
    yield first
    yield from rest


def _built_schema(conv: pa.DataType) -> pa.Schema:
    counts = [(c, pa.int64()) for c in ("at", *COUNTS)]
    texts = [("audit", pa.string()), ("repaired", pa.string())]
    return pa.schema([("conv_id", conv), *counts, *texts, ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Join condition: equal columns, nulls equal to nulls."""
    out = F.lit(True)
    for n in names:
        out = out & left[n].eqNullSafe(right[n])
    return out


def _met(left: DataFrame, right: DataFrame, names: tuple[str, ...], how: str = "left") -> DataFrame:
    """``left`` with the other columns of ``right``."""
    more = [c for c in right.columns if c not in names]
    renamed = right.select(*(F.col(n).alias(f"right_{n}") for n in names), *more)
    on = F.lit(True)
    for n in names:
        on = on & left[n].eqNullSafe(renamed[f"right_{n}"])
    return left.join(renamed, on, how).select(*(left[c] for c in left.columns), *more)


def _repeats(segments: DataFrame) -> DataFrame:
    """conv_id, at, repeated: the places in each segment of rows seen earlier in their conversation."""
    row = segments.select("conv_id", "at", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "m"))
    name = F.sha2(F.concat(F.length("m.roles").cast("string"), F.lit(":"), "m.roles", "m.texts").cast("binary"), 256)
    named = cut(row.select("conv_id", F.struct("at", "place").alias("where"), name.alias("name")), "message-names")
    several = named.groupBy("conv_id", "name").agg(F.min("where").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = _met(named, several, ("conv_id", "name"), "inner").filter(F.col("where") != F.col("first"))
    return later.groupBy("conv_id", F.col("where.at").alias("at")).agg(F.collect_list("where.place").alias("repeated"))


def _map_rows(df: DataFrame, schema: str, one) -> DataFrame:
    """``one`` maps each row, a dict, to the rows it gives; ``schema`` without conv_id, which is kept."""
    kind = df.schema["conv_id"].dataType.simpleString()
    layout = df.sparkSession.createDataFrame([], f"conv_id {kind}, {schema}").schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(layout)
        for batch in batches:
            for a in range(0, len(batch), 256):
                got = [{"conv_id": row["conv_id"]} | x for row in batch.slice(a, 256).to_pylist() for x in one(row)]
                yield pa.RecordBatch.from_pylist(got, schema=target)

    return map_arrow(df, run, layout)


def _states(elements: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """conv_id, number, entry, leave of each numbered element, and the tables written on the way."""
    nodes, levels, written = elements, [], []
    while not nodes.filter("number > 0").isEmpty():
        parent = F.shiftright("number", FAN_OUT.bit_length() - 1)
        kids = nodes.groupBy("conv_id", parent.alias("parent")).agg(F.sort_array(F.collect_list(F.struct("number", "element"))).alias("kids"))
        levels.append(cut(kids.withColumnRenamed("parent", "number"), "level"))
        whole = lambda row: [{"number": row["number"], "element": hb.compose([hb.Element.of(k["element"]) for k in row["kids"]]).flat()}]
        nodes = cut(_map_rows(levels[-1], "number long, element array<long>", whole), "level-elements")
        written += [levels[-1], nodes]
    found = nodes.select("conv_id", "number", F.lit(0).alias("entry"), F.lit(0).alias("leave"))

    def below(row):
        at = hb.crossings([hb.Element.of(k["element"]) for k in row["kids"]], row["entry"], row["leave"])
        return [{"number": k["number"], "entry": at[i], "leave": at[i + 1]} for i, k in enumerate(row["kids"])]

    for level in reversed(levels):
        found = cut(_map_rows(_met(level, found, ("conv_id", "number"), "inner"), "number long, entry int, leave int", below), "level-states")
        written.append(found)
    return found, written


def _digests(chunks: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of chunks in the order of ``at``; one row of a conversation after the other."""
    layout = chunks.select("conv_id", F.lit("").alias("repaired_sha256")).schema
    dealt = chunks.filter(F.col("chunk").isNotNull()).repartition("conv_id").sortWithinPartitions("conv_id", "at").select("conv_id", "chunk")

    def run(batches):
        now, conv, kind, held = None, None, None, []

        def record():
            out = pa.RecordBatch.from_arrays([pa.array([c for c, _ in held], kind), pa.array([h for _, h in held], pa.string())], ["conv_id", "repaired_sha256"])
            held.clear()
            return out

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for c, chunk in zip(batch.column("conv_id"), batch.column("chunk"), strict=True):
                c = c.as_py()
                if now is None or c != conv:
                    if now is not None:
                        held.append((conv, now.hexdigest()))
                    now, conv = hashlib.sha256(), c
                else:
                    now.update(b"\n")
                now.update(chunk.as_py().encode())
            if held:
                yield record()
        if now is not None:
            held.append((conv, now.hexdigest()))
            yield record()

    return map_arrow(dealt, run, layout)


def _from_segments(segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repaired messages by segment, one row a conversation) of conversations in segments."""
    of_conv = Window.partitionBy("conv_id").orderBy("at")
    counted = Window.partitionBy("conv_id")
    named = segments.select("conv_id", "at", F.row_number().over(of_conv).cast("long").alias("nth"), F.max("at").over(counted).alias("last_at"))
    named = named.withColumns({"number": F.col("nth") - 1, "last": F.col("at") == F.col("last_at")}).drop("nth", "last_at")
    held = _met(_met(segments.select("conv_id", "at", "roles", "texts"), _repeats(segments), ("conv_id", "at")), named, ("conv_id", "at"))

    def classed(row):
        kinds, counts = faults(row["roles"], row["texts"], set(row["repeated"] or ()))
        kinds += hb.END if row["last"] else ""
        whole = hb.compose([hb.element(k) for k in kinds]).flat()
        ends = {"head": row["roles"][0][:1], "tail": row["roles"][-1][:1]}
        return [counts | ends | {"number": row["number"], "kinds": kinds, "element": whole, "roles": row["roles"], "texts": row["texts"]}]

    counts = ", ".join(f"{c} long" for c in COUNTS)
    kinds = cut(
        _map_rows(held, f"number long, {counts}, head string, tail string, kinds string, element array<long>, roles array<string>, texts array<string>", classed),
        "segment-classes",
    )
    states, written = _states(kinds.select("conv_id", "number", "element"))

    def rebuilt(row):
        cost, letters, at = hb.solve(row["kinds"], row["entry"], row["leave"])
        chunk = lines(hb.repaired(row["roles"], row["texts"], letters, at))
        return [{c: row[c] for c in ("number", "blank", "duplicate", "truncated", "illegal", "head", "tail")} | {"cost": cost, "audit": "".join(letters), "chunk": chunk}]

    done = cut(_map_rows(_met(kinds, states, ("conv_id", "number"), "inner"), f"number long, {counts}, head string, tail string, audit string, chunk string", rebuilt), "segment-audits")
    drop(kinds, *written)
    parts = F.sort_array(F.collect_list(F.struct("number", "audit", "head", "tail")))
    sums = done.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in COUNTS), parts.alias("parts"))
    seam = F.expr("size(filter(transform(sequence(1, greatest(size(parts) - 1, 1)), i -> concat(parts[i - 1].tail, get(parts, i).head)), x -> x not in ('su', 'ua', 'au')))")
    sums = sums.withColumns({"illegal": F.col("illegal") + seam, "audit": F.array_join(F.transform("parts", lambda x: x["audit"]), "")}).drop("parts")
    return done.select("conv_id", F.col("number").alias("at"), "chunk"), sums


def repair(rows: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> tuple[DataFrame, DataFrame]:
    """(messages, conversations) of rows as ``rows_of`` gives them.

    messages: conv_id, at, chunk; a conversation's chunks of ``role:text`` lines
    in the order of ``at`` are its repaired text. conversations: conv_id, counts
    of faults, illegal neighbours, cost, audit and the digest of that text.
    """
    built = cut(build(rows, max_rows, max_bytes), "conversations")
    whole = built.filter(F.col("audit").isNotNull())
    chunks, sums = _from_segments(built.filter(F.col("audit").isNull()))
    digests = _met(sums, _digests(chunks), ("conv_id",)).withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    short = whole.select("conv_id", *COUNTS, "audit", F.sha2(F.col("repaired").cast("binary"), 256).alias("repaired_sha256"))
    messages = whole.select("conv_id", F.lit(0).cast("long").alias("at"), F.nullif("repaired", F.lit("")).alias("chunk"))
    return messages.unionByName(chunks), short.unionByName(digests.select(short.columns))


def report(original: DataFrame, rows: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row for every conversation of ``original``, from the rows left of it."""
    turns = rows.select("conv_id", "turn").distinct().groupBy("conv_id")
    gaps = turns.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    everything = _met(original.select("conv_id").distinct(), gaps, ("conv_id",))
    found = _met(everything, repair(rows, max_rows, max_bytes)[1], ("conv_id",))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("gaps", *COUNTS)}
    empty = {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))}
    return found.withColumns(zero | empty)
