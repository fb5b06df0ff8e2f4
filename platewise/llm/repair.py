"""Repair of conversations by a parallel Viterbi search whose chunks converge in rank.

Turns are put in order and cut into chunks. What it costs to end a conversation well from
each of four states is worked backward through every chunk at once: the last chunk starts
from the true costs, the others from a guess. A fix-up pass gives each chunk the vector
that its successor found and reruns it where the two differ by more than a constant, until
none does. The stitched costs then drive the tracing: at each turn the least letter whose
cost is met. A chunk traces from each state it may be entered in; the chunks' maps of
states say which of these is the true one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm.common import map_arrow
from platewise.operators.joins import join_null_safe
from platewise.session import materialize, small_side

# A chunk has at most 2 ** CHUNK_BITS turns.
CHUNK_BITS = 12
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
WHITE = " \t\n\x0b\x0c\r"
# States: nothing said, a system turn said, the user spoke last, the assistant did.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
# Costs of ending with no turn left, inserts included.
END = (0, 2 * INSERT, INSERT, 0)
# A turn as a number: three times the place of its initial here, plus 0, 1 if truncated, 2 if blank.
INITIALS = "uasx"
# Inside this module a kept system turn has a letter of its own.
KEPT_SYSTEM = "S"


def _turn_code(role: Column, text: Column) -> Column:
    """Initial and fault of a turn as one number, see ``INITIALS``."""
    initial = F.substring(role, 1, 1)
    which = F.when(initial == "u", 0).when(initial == "a", 1).when(initial == "s", 2).otherwise(3)
    last = F.right(F.rtrim(text, F.lit(WHITE)), F.lit(1))
    fault = F.when(last == "", 2).when(last.isin(".", "!", "?"), 0).otherwise(1)
    return (which * 3 + fault).cast("int")


def _closed(v: list[int]) -> list[int]:
    """Costs where turns may be inserted first."""
    user, assistant = min(v[2], INSERT + v[3]), min(v[3], INSERT + v[2])
    return [min(v[0], INSERT + user), min(v[1], INSERT + user), user, assistant]


def _before(v: list[int], code: int, forced: bool) -> list[int]:
    """Costs before a turn from those after it."""
    if forced:
        # All states pay alike, so inserts are settled already.
        return [c + DELETE for c in v]
    initial, late = code // 3, TRUNCATED if code % 3 else 0
    to_user = v[USER] + late + (KEEP if initial == 0 else REROLE)
    to_assistant = v[ASSISTANT] + late + (KEEP if initial == 1 else REROLE)
    found = [
        min(v[0] + DELETE, to_user),
        min(v[1] + DELETE, to_user),
        min(v[2] + DELETE, to_assistant),
        min(v[3] + DELETE, to_user),
    ]
    if initial == 2:
        found[START] = min(found[START], v[SYSTEM] + late + KEEP)
    return _closed(found)


def run_chunk(codes: list[int], forced: list[bool], after: list[int]) -> list[list[int]]:
    """Cost vectors before each turn, and last the one after all."""
    vectors = [after]
    for code, gone in zip(reversed(codes), reversed(forced)):
        vectors.append(_before(vectors[-1], code, gone))
    vectors.reverse()
    return vectors


def trace_chunk(
    codes: list[int], forced: list[bool], vectors: list[list[int]], state: int, last: bool
) -> tuple[int, str]:
    """The state after the chunk and the least letters of cheapest edits from ``state``.

    Turns inserted after the last turn belong to the next chunk, if there is one.
    """
    letters, at, size = [], 0, len(codes)
    while at < size or last:
        here = vectors[at]
        cost, following = here[state], _NEXT[state]
        if at < size and vectors[at + 1][state] + DELETE == cost:
            letters.append("D")
            at += 1
            continue
        if at == size and cost == 0 and state in (START, ASSISTANT):
            break
        if here[following] + INSERT == cost:
            letters.append("I")
            state = following
            continue
        after, initial = vectors[at + 1], codes[at] // 3
        late = TRUNCATED if codes[at] % 3 else 0
        if initial == 2 and state == START and after[SYSTEM] + late + KEEP == cost:
            letters.append(KEPT_SYSTEM)
            state = SYSTEM
        else:
            kept = initial == (1 if state == USER else 0) and after[following] + late + KEEP == cost
            letters.append("K" if kept else "R")
            state = following
        at += 1
    return state, "".join(letters)


def _normal(vector: list[int]) -> tuple[list[int], int]:
    least = min(vector)
    return [c - least for c in vector], least


def in_order(turns: DataFrame) -> DataFrame:
    """Turns with ``id``, a number in the order of conversation, turn, role and text, nulls first.

    Columns ``conv_id``, ``turn``, ``role``, ``text``; of the last two a null is one
    space. Equal turn numbers go by role, then by the text's MD5. Rows are dealt out by
    ranges of that order with the row's place last, so neither a long conversation nor
    very many equal rows meet in one task.
    """
    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.monotonically_increasing_id().alias("place"),
    ).withColumn("digest", F.md5(F.encode("text", "UTF-8")))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", "place")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("place", "digest")
    return materialize(ranged.withColumn("id", F.monotonically_increasing_id()), "turns-in-order")


def _chunk(id_: Column, bits: int) -> tuple[Column, Column]:
    return F.shiftright(id_, bits).alias("chunk"), id_.bitwiseAND((1 << bits) - 1).cast("int").alias("at")


def _packed(ordered: DataFrame, bits: int) -> DataFrame:
    """One row a conversation and chunk: its turns' codes and which of them say something first."""
    chunk, at = _chunk(F.col("id"), bits)
    turns = ordered.select("conv_id", chunk, at, _turn_code(F.col("role"), F.col("text")).alias("code"))
    said = ordered.groupBy("conv_id", "role", F.sha2(F.encode("text", "UTF-8"), 256).alias("said"))
    firsts = said.agg(F.min("id").alias("id")).select("conv_id", chunk, at, F.lit(None).cast("int").alias("code"))
    together = turns.unionAll(firsts).groupBy("conv_id", "chunk")
    # A chunk has a bounded number of turns, so these lists have too.
    return materialize(
        together.agg(
            F.sort_array(F.collect_list(F.when(F.col("code").isNotNull(), F.struct("at", "code")))).alias("turns"),
            F.sort_array(F.collect_list(F.when(F.col("code").isNull(), F.col("at")))).alias("firsts"),
        ),
        "chunks",
    )


def _turns_of(batch: pa.RecordBatch, row: int) -> tuple[int, list[int], list[bool]]:
    """First place, codes and forced deletes of a packed chunk."""
    turns = batch.column("turns")[row].values
    at = turns.field("at").to_numpy()
    codes = turns.field("code").to_numpy()
    first = np.isin(at, batch.column("firsts")[row].values.to_numpy())
    forced = (codes % 3 == 2) | ~first
    return int(at[0]), codes.tolist(), forced.tolist()


_RUN = "conv_id long, chunk long, right array<int>, left array<int>, shift long, start long"


def _run(packed: DataFrame) -> DataFrame:
    """Work through chunks from ``right``; gives their ``left`` vector less ``shift``, and the true
    cost of the conversation if it starts here, less what lies behind."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        out = {c: [] for c in ("right", "left", "shift", "start")}
        for row in range(batch.num_rows):
            _, codes, forced = _turns_of(batch, row)
            right = batch.column("right")[row].as_py()
            first = run_chunk(codes, forced, right)[0]
            left, shift = _normal(first)
            for name, value in zip(out, (right, left, shift, first[START])):
                out[name].append(value)
        yield {"conv_id": batch.column("conv_id"), "chunk": batch.column("chunk"), **out}

    return map_arrow(packed.select("conv_id", "chunk", "turns", "firsts", "right"), run, _RUN)


_KEY = ["conv_id", "chunk"]


def converge(packed: DataFrame) -> tuple[DataFrame, int]:
    """The final runs of all chunks and the number of fix-up passes.

    The first pass starts every chunk from ``END``, the truth for the last chunk of a
    conversation. A later pass reruns the chunks whose successor found a vector that is
    not the one they started from plus a constant. When none is left, every vector is
    true: the last by construction, each other by its successor. Chunks forget what
    follows within a few turns that are kept, so passes are few; a stretch of which
    every turn goes is what the guess is right about. At worst there are as many passes
    as a conversation has chunks.
    """
    runs = materialize(_run(packed.withColumn("right", F.array(*map(F.lit, END)))), "runs")
    following = F.lead("chunk").over(Window.partitionBy("conv_id").orderBy("chunk"))
    # Keys only: as many rows as chunks.
    links = packed.select(*_KEY).withColumn("next", following).filter("next IS NOT NULL")
    links = materialize(links, "chunk-links")
    if not links.limit(1).count():
        return runs, 0
    passes = 0
    while True:
        mine = join_null_safe(links, runs.select(*_KEY, F.col("right").alias("used")), _KEY)
        theirs = runs.select("conv_id", F.col("chunk").alias("next"), F.col("left").alias("right"))
        met = join_null_safe(mine, theirs, ["conv_id", "next"])
        stale = materialize(met.filter(F.col("used") != F.col("right")).select(*_KEY, "right"), "stale-chunks")
        count = stale.count()
        if not count:
            return runs, passes
        passes += 1
        side = small_side(stale, count)
        again = _run(join_null_safe(packed, side, _KEY))
        kept = join_null_safe(runs, side.select(*_KEY), _KEY, "left_anti")
        runs = materialize(kept.unionAll(again), "runs")


def _traced(packed: DataFrame, runs: DataFrame) -> DataFrame:
    """Per chunk, for each state it may be entered in, the state after it and the letters; and counts."""
    schema = (
        "conv_id long, chunk long, at int, exits array<int>, letters array<string>, shift long, start long, "
        "blank long, duplicate long, truncated long, illegal long, head string, tail string"
    )
    order = Window.partitionBy("conv_id").orderBy("chunk")
    ends = runs.select(*_KEY, "right", "shift", "start", (F.lead("chunk").over(order).isNull()).alias("last"),
                       (F.lag("chunk").over(order).isNull()).alias("first"))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        names = ("at", "exits", "letters", "blank", "duplicate", "truncated", "illegal", "head", "tail")
        out = {n: [] for n in names}
        for row in range(batch.num_rows):
            at, codes, forced = _turns_of(batch, row)
            vectors = run_chunk(codes, forced, batch.column("right")[row].as_py())
            last, first = batch.column("last")[row].as_py(), batch.column("first")[row].as_py()
            found = [trace_chunk(codes, forced, vectors, s, last) for s in ((START,) if first else range(4))]
            initials = "".join(INITIALS[c // 3] for c in codes)
            legal = sum(initials[i : i + 2] in ("su", "ua", "au") for i in range(len(codes) - 1))
            blank = sum(c % 3 == 2 for c in codes)
            values = (
                at, [s for s, _ in found], [x for _, x in found], blank, sum(forced) - blank,
                sum(c % 3 == 1 and not f for c, f in zip(codes, forced)),
                len(codes) - 1 - legal, initials[0], initials[-1],
            )
            for name, value in zip(names, values):
                out[name].append(value)
        keys = {c: batch.column(c) for c in ("conv_id", "chunk", "shift", "start")}
        yield {**keys, **out}

    both = join_null_safe(packed, ends, _KEY)
    columns = ["conv_id", "chunk", "turns", "firsts", "right", "shift", "start", "last", "first"]
    return materialize(map_arrow(both.select(*columns), run, schema), "traced")


def _entered(traced: DataFrame) -> DataFrame:
    """``entry``, the state in which each chunk is entered, and ``whole``: the conversation's only chunk.

    Per conversation the chunks' maps of four states are folded in order; a map is a few
    bytes, one for thousands of turns.
    """
    maps = traced.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "exits"))).alias("maps"))
    several = maps.filter(F.size("maps") > 1)
    walk = F.aggregate(
        "maps",
        F.array(F.lit(START)),
        lambda seen, m: F.concat(
            seen,
            F.array(F.get(m["exits"], F.when(F.size(m["exits"]) == 1, 0).otherwise(F.element_at(seen, -1)))),
        ),
    )
    placed = several.select("conv_id", F.explode(F.arrays_zip(F.col("maps.chunk").alias("chunk"), walk.alias("entry"))).alias("z"))
    placed = placed.select("conv_id", F.col("z.chunk").alias("chunk"), F.col("z.entry").alias("entry")).filter("chunk IS NOT NULL")
    joined = join_null_safe(traced, placed, _KEY, "left")
    state = F.coalesce("entry", F.lit(START))
    letters = F.get("letters", F.when(F.size("letters") == 1, 0).otherwise(state))
    return joined.withColumns({"whole": F.col("entry").isNull(), "entry": state, "letters": letters}).drop("exits")


@dataclass(frozen=True)
class Repair:
    """``audits``: one row a conversation; ``turns``: those that stay or are put in, in order.

    ``turns`` has ``conv_id``, ``chunk``, ``place`` (rising within a chunk), ``whole``,
    ``role``, ``text`` and ``edit``; its partitions hold whole chunks in order.
    """

    audits: DataFrame
    turns: DataFrame
    passes: int


def _audits(ordered: DataFrame, chosen: DataFrame) -> DataFrame:
    numbers = ordered.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    before = F.lag("tail").over(Window.partitionBy("conv_id").orderBy("chunk"))
    # One row a chunk, not a turn.
    meeting = F.concat(before, F.col("head"))
    edges = chosen.select(
        "conv_id", "chunk", F.translate("letters", KEPT_SYSTEM, "K").alias("letters"), "shift", "start",
        "blank", "duplicate", "truncated", before.isNull().alias("first"),
        (F.col("illegal") + F.when(meeting.isNull() | meeting.isin("su", "ua", "au"), 0).otherwise(1)).alias("illegal"),
    )
    sums = edges.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        # The first chunk is entered in its starting state, all others add what their least state costs.
        F.sum(F.when(F.col("first"), F.col("start")).otherwise(F.col("shift"))).alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "letters"))), lambda c: c["letters"]), "").alias("audit"),
    )
    return join_null_safe(numbers, sums, ["conv_id"])


def _repaired(ordered: DataFrame, chosen: DataFrame, bits: int) -> DataFrame:
    """Texts and edits meet by chunk in one shuffle and are merged in one pass of each sorted partition."""

    def items(batch: pa.RecordBatch) -> Iterator[dict]:
        for row in range(batch.num_rows):
            state, at = batch.column("entry")[row].as_py(), batch.column("at")[row].as_py()
            out = {n: [] for n in ("at", "place", "role", "edit")}
            for place, letter in enumerate(batch.column("letters")[row].as_py()):
                if letter != "D":
                    state = SYSTEM if letter == KEPT_SYSTEM else _NEXT[state]
                    edit = "K" if letter == KEPT_SYSTEM else letter
                    for name, value in zip(out, (at, place, None if edit == "K" else _ROLE[state], edit)):
                        out[name].append(value)
                at += letter != "I"
            size = len(out["at"])
            keys = {c: pa.array([batch.column(c)[row].as_py()] * size) for c in ("conv_id", "chunk", "whole")}
            yield {**{c: a.cast(pa.bool_() if c == "whole" else pa.int64()) for c, a in keys.items()}, **out}

    edits = map_arrow(
        chosen.select("conv_id", "chunk", "at", "letters", "entry", "whole"),
        items,
        "conv_id long, chunk long, whole boolean, at int, place int, role string, edit string",
    )
    chunk, at = _chunk(F.col("id"), bits)
    nothing = {c: F.lit(None).cast(t) for c, t in (("whole", "boolean"), ("place", "int"), ("edit", "string"))}
    texts = ordered.select("conv_id", chunk, at, "role", "text").withColumns(nothing)
    both = texts.unionByName(edits.withColumn("text", F.lit(None).cast("string")))
    columns = ["conv_id", "chunk", "at", "place", "whole", "role", "text", "edit"]
    # Edits come before the text of the turn that they keep or follow.
    order = [F.col("conv_id"), F.col("chunk"), F.col("at"), F.col("place").asc_nulls_last()]
    dealt = both.select(*columns).repartition("conv_id", "chunk").sortWithinPartitions(*order)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = []
            for row in range(batch.num_rows):
                edit = batch.column(7)[row].as_py()
                key = tuple(batch.column(i)[row].as_py() for i in range(3))
                if edit is None:
                    if held and held[0] == key:
                        (conv_id, part, _), place, whole, role, letter = held
                        rows.append((conv_id, part, place, whole, role or batch.column(5)[row].as_py(), batch.column(6)[row].as_py(), letter))
                    held = None
                    continue
                place, whole, role = (batch.column(i)[row].as_py() for i in (3, 4, 5))
                if edit == "I":
                    rows.append((key[0], key[1], place, whole, role, "", edit))
                else:
                    held = key, place, whole, role, edit
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _TURNS)], schema=_TURNS)

    return dealt.mapInArrow(merge, "conv_id long, chunk long, place int, whole boolean, role string, text string, edit string")


_TURNS = pa.schema(
    [("conv_id", pa.int64()), ("chunk", pa.int64()), ("place", pa.int32()), ("whole", pa.bool_())]
    + [(n, pa.string()) for n in ("role", "text", "edit")]
)


def repair_conversations(turns: DataFrame) -> Repair:
    """Cheapest edits that leave the roles ``(system? (user assistant)+)?``, least letters among equals.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are not
    read. Roles count by their first letter. A turn is blank without a character that is
    no ASCII white space, else a duplicate if its conversation had its role and text
    before, else truncated if its last such character is none of ``.!?``. Blank turns
    and duplicates have to go. Keeping costs 0, another role 1, deleting 2, an inserted
    turn without text 5, a truncated turn that stays 5 more.

    Nulls in role and text are one space, a null conversation is one of its own, null
    turn numbers come first. Equal turns are ordered by role and text, repeated rows are
    duplicates. Texts are read whole, whatever their length; an empty table gives none.
    """
    bits = CHUNK_BITS
    ordered = in_order(turns)
    packed = _packed(ordered, bits)
    runs, passes = converge(packed)
    chosen = materialize(_entered(_traced(packed, runs)), "edits")
    return Repair(_audits(ordered, chosen), _repaired(ordered, chosen, bits), passes)


def conversation_digests(turns: DataFrame, part_bytes: int = 1 << 20) -> DataFrame:
    """SHA-256 of the turns of each conversation as ``role:text``, joined by line ends.

    ``turns`` as ``Repair`` has them. A conversation of one chunk is hashed where it
    lies. Of others the bytes go on in parts, which one task a conversation streams
    through its hash in order, holding one at a time: SHA-256 has no other order.
    """
    import hashlib

    names = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("part", pa.int32()), ("digest", pa.string()), ("bytes", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, whole, digest, waiting, part = None, None, None, bytearray(), 0

        def row(values: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, names)], schema=names)

        def close() -> Iterator[pa.RecordBatch]:
            if key is not None and whole:
                yield row((*key, 0, digest.hexdigest(), None))
            elif key is not None and waiting:
                yield row((*key, part, None, bytes(waiting)))

        done: list[pa.RecordBatch] = []
        for batch in batches:
            roles, texts = batch.column(4), batch.column(5)
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for i, found in enumerate(keys):
                if found != key:
                    done += close()
                    key, whole, digest, waiting, part = found, batch.column(3)[i].as_py(), hashlib.sha256(), bytearray(), 0
                    begun = False
                line = b"%s:%s" % (roles[i].as_py().encode(), texts[i].as_py().encode())
                if whole:
                    digest.update(b"\n" + line if begun else line)
                else:
                    # Every part of a longer conversation ends its lines; the last end is taken off.
                    waiting += line + b"\n"
                    if len(waiting) >= part_bytes:
                        done.append(row((*key, part, None, bytes(waiting))))
                        waiting, part = bytearray(), part + 1
                begun = True
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                done = []
        yield from close()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, open_end, out = None, None, b"", []
        for batch in batches:
            for i in range(batch.num_rows):
                found = (batch.column(0)[i].as_py(),)
                if found != key:
                    if key is not None:
                        out.append((key[0], digest.hexdigest()))
                    key, digest, open_end = found, hashlib.sha256(), b""
                held = batch.column(3)[i].as_py()
                digest.update(open_end + held[:-1])
                open_end = b"\n"
        if key is not None:
            out.append((key[0], digest.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], type=pa.int64()), pa.array([d for _, d in out])], names=["conv_id", "digest"])

    parts = turns.mapInArrow(cut, "conv_id long, chunk long, part int, digest string, bytes binary")
    parts = materialize(parts, "digest-parts")
    whole = parts.filter("digest IS NOT NULL").select("conv_id", "digest")
    longer = parts.filter("digest IS NULL").select("conv_id", "chunk", "part", "bytes").repartition("conv_id")
    longer = longer.sortWithinPartitions("conv_id", "chunk", "part")
    return whole.unionAll(longer.mapInArrow(stream, "conv_id long, digest string"))
