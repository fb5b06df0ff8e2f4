"""Chat formatting: tool calls linked with their results, checked and serialised."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.operators.ranking import with_row_number
from platewise.session import materialize

# Roles of turns that are neither calls nor results.
MESSAGE_ROLES = ("system",)
# What a field of a tool's schema may say.
KEYWORDS = {"type", "required", "minimum", "maximum", "max_length"}
_KINDS = {
    "string": ["STRING"],
    "integer": ["BIGINT"],
    "number": ["BIGINT", "DOUBLE", "DECIMAL"],
    "boolean": ["BOOLEAN"],
}


def _field_errors(name: str, rules: Mapping[str, object]) -> list[Column]:
    if unknown := set(rules) - KEYWORDS:
        raise ValueError(f"unknown schema keywords: {sorted(unknown)}")
    path = f"$['{name}']"
    value = F.try_variant_get("parsed", path, "variant")
    kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    # A field that is null counts as absent.
    there = value.isNotNull() & (kind != "VOID")
    fits = there & kind.isin(_KINDS[str(rules["type"])])
    number = F.try_variant_get("parsed", path, "double")
    size = F.length(F.try_variant_get("parsed", path, "string"))
    found = [F.when(there & ~fits, f"{name}: not {rules['type']}")]
    if rules.get("required"):
        found.append(F.when(~F.coalesce(there, F.lit(False)), f"{name}: missing"))
    if "minimum" in rules:
        found.append(F.when(fits & (number < F.lit(rules["minimum"])), f"{name}: too small"))
    if "maximum" in rules:
        found.append(F.when(fits & (number > F.lit(rules["maximum"])), f"{name}: too large"))
    if "max_length" in rules:
        found.append(F.when(fits & (size > F.lit(rules["max_length"])), f"{name}: too long"))
    return found


def argument_errors(schemas: Mapping[str, Mapping[str, Mapping[str, object]]]) -> Column:
    """Faults of ``parsed`` (a variant) and ``arguments`` (its text) for the row's ``tool``."""
    tool = F.col("tool")
    per_tool = F.when(~F.coalesce(tool.isin(list(schemas)), F.lit(False)), F.array(F.lit("unknown tool")))
    per_tool = per_tool.when(
        ~F.coalesce(F.schema_of_variant("parsed").startswith("OBJECT"), F.lit(False)),
        F.array(F.lit("arguments are no object")),
    )
    for name, fields in schemas.items():
        checks = [e for field in sorted(fields) for e in _field_errors(field, fields[field])]
        others = F.array_except(F.json_object_keys("arguments"), F.array(*[F.lit(f) for f in fields]))
        extra = F.transform(F.array_sort(others), lambda k: F.concat(k, F.lit(": not in schema")))
        faults = F.concat(F.array_compact(F.array(*checks)), extra)
        per_tool = per_tool.when(tool == name, faults)
    return per_tool


def call_depths(calls: DataFrame) -> DataFrame:
    """Columns ``conv_id``, ``call_id``, ``depth``: calls that must come before it on its chain.

    ``calls`` has one row a ``conv_id`` and ``call_id``, and ``after``, the call
    whose result it needs. Each round doubles how far back a call has looked, so a
    chain of any length takes a number of rounds that grows with its logarithm.
    Calls that wait for each other, and what waits for them, get a null depth.
    """
    parent = calls.select("conv_id", F.col("call_id").alias("back"))
    known = _on(calls.alias("c"), parent.alias("p"), {"conv_id": "conv_id", "after": "back"}, "left")
    back = F.col("p.back")
    depth = F.when(back.isNull(), 0).otherwise(1).cast("long").alias("depth")
    state = materialize(known.select("c.conv_id", "c.call_id", back.alias("back"), depth), "depths")
    waiting = state.filter("back is not null").count()
    looked = 1
    while waiting and looked <= waiting:
        ahead = state.select("conv_id", "call_id", "back", "depth")
        met = _on(state.alias("c"), ahead.alias("p"), {"conv_id": "conv_id", "back": "call_id"}, "left")
        state = materialize(
            met.select(
                "c.conv_id",
                "c.call_id",
                F.col("p.back").alias("back"),
                (F.col("c.depth") + F.coalesce("p.depth", F.lit(0))).alias("depth"),
            ),
            "depths",
        )
        looked *= 2
        if not state.filter("back is not null").limit(1).count():
            break
    return state.select("conv_id", "call_id", F.when(F.col("back").isNull(), F.col("depth")).alias("depth"))


def _on(left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str) -> DataFrame:
    """Hash join of aliases ``c`` and ``p``; conversations match null-safe, identifiers do not."""
    condition = F.lit(True)
    for a, b in keys.items():
        x, y = F.col(f"c.{a}"), F.col(f"p.{b}")
        condition = condition & (x.eqNullSafe(y) if a == "conv_id" else x == y)
    return left.join(right.hint("shuffle_hash"), condition, how)


def link_tool_calls(
    calls: DataFrame,
    results: DataFrame,
    schemas: Mapping[str, Mapping[str, Mapping[str, object]]],
    messages: DataFrame | None = None,
) -> DataFrame:
    """One row a call, one for each identifier that only results name, and one a message.

    ``calls`` has ``conv_id``, ``call_id``, ``turn``, ``tool``, ``arguments`` (JSON text)
    and ``after`` (the call whose result it needs, or null); ``results`` has
    ``conv_id``, ``call_id``, ``turn``, ``content``; ``messages``, the turns that are
    neither, have ``conv_id``, ``turn``, ``role``, ``content``. Other columns are not
    read, so their names do not matter.

    Columns: ``conv_id``, ``position`` (from 0, its place in the conversation: fewer
    calls to wait for first, then turn, identifier and text), ``call_id``, ``tool``,
    ``depth``, ``valid``, ``errors`` (joined by "; "), ``results`` (how many it has) and
    ``line``: JSON with sorted keys and no spaces, of ``arguments``, ``id``, ``result``
    and ``tool``, nulls left out.

    Repeated rows of calls count once. Of other calls with one identifier the
    earliest turn has it (equal: the smallest text); the rest are ``duplicate id`` and
    get no result. The earliest result of an identifier is linked. A call without
    identifier has no result (``no id``); one that names an unknown predecessor
    starts a chain (``unknown predecessor``); calls in a circle come last (``circle``).
    Arguments that are no JSON stay out of the line. A message waits for no call, so its
    depth is 0; its line is JSON of ``content`` and ``role``, and a role that is null
    (``no role``) or none of ``MESSAGE_ROLES`` (``unknown role``) is a fault. Repeated
    messages stay. Long texts are serialised whole. Empty tables give no rows.
    """
    fields = ("turn", "tool", "arguments", "after")
    calls = calls.select("conv_id", "call_id", *fields).distinct()
    calls = calls.withColumn("body", F.struct(*fields))
    first = calls.groupBy("conv_id", "call_id").agg(F.min("body").alias("first"))
    held = _on(calls.alias("c"), first.alias("p"), {"conv_id": "conv_id", "call_id": "call_id"}, "left")
    held = held.select("c.*", F.col("c.body").eqNullSafe(F.col("p.first")).alias("holds"))
    held = materialize(held.drop("body"), "calls")
    holders = held.filter(F.col("holds") & F.col("call_id").isNotNull())
    depths = call_depths(holders.select("conv_id", "call_id", "after"))
    answers = results.groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "content")).alias("answer"), F.count("*").alias("results")
    )
    known = _on(
        holders.alias("c"), depths.alias("p"), {"conv_id": "conv_id", "call_id": "call_id"}, "left"
    ).select("c.*", "p.depth")
    others = held.filter(~F.coalesce(F.col("holds"), F.lit(False)) | F.col("call_id").isNull())
    ids = holders.select("conv_id", F.col("call_id").alias("known")).alias("p")
    linked = _on(
        known.alias("c"), answers.alias("p"), {"conv_id": "conv_id", "call_id": "call_id"}, "full"
    ).select(
        F.when(F.col("c.holds").isNull(), F.col("p.conv_id")).otherwise(F.col("c.conv_id")).alias("conv_id"),
        F.coalesce("c.call_id", "p.call_id").alias("call_id"),
        F.coalesce("c.turn", "p.answer.turn").alias("turn"),
        "c.tool", "c.arguments", "c.after", "c.depth",
        F.col("p.answer.content").alias("content"),
        F.coalesce("p.results", F.lit(0).cast("long")).alias("results"),
        F.when(F.col("c.holds").isNull(), "no call").when(F.col("c.depth").isNull(), "circle").alias("fault"),
    )
    unlinked = others.select(
        "conv_id", "call_id", "turn", "tool", "arguments", "after",
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("string").alias("content"),
        F.lit(0).cast("long").alias("results"),
        F.when(F.col("call_id").isNull(), "no id").otherwise("duplicate id").alias("fault"),
    )
    rows = _on(linked.unionByName(unlinked).alias("c"), ids, {"conv_id": "conv_id", "after": "known"}, "left")
    lost = F.when(F.col("c.after").isNotNull() & F.col("p.known").isNull(), "unknown predecessor")
    rows = rows.select("c.*", lost.alias("lost")).withColumn("parsed", F.try_parse_json("arguments"))
    faults = F.when(F.col("fault").eqNullSafe("no call"), F.array("fault")).otherwise(
        F.concat(F.array_compact(F.array("fault", "lost")), argument_errors(schemas))
    )
    # The struct's fields are in order of name, and so are a variant's.
    line = F.to_json(
        F.struct(
            F.col("parsed").alias("arguments"),
            F.col("call_id").alias("id"),
            F.col("content").alias("result"),
            "tool",
        )
    )
    formed = rows.select(
        "conv_id", "call_id", "turn", "tool", "depth", "results",
        (F.size(faults) == 0).alias("valid"),
        F.concat_ws("; ", faults).alias("errors"),
        line.alias("line"),
    )
    if messages is not None:
        role = F.col("role").cast("string")
        fault = F.when(role.isNull(), "no role").when(~role.isin(*MESSAGE_ROLES), "unknown role").otherwise("")
        told = messages.select(
            "conv_id",
            F.lit(None).cast("string").alias("call_id"),
            "turn",
            F.lit(None).cast("string").alias("tool"),
            F.lit(0).cast("long").alias("depth"),
            F.lit(0).cast("long").alias("results"),
            (fault == "").alias("valid"),
            fault.alias("errors"),
            F.to_json(F.struct(F.col("content").cast("string").alias("content"), role.alias("role"))).alias("line"),
        )
        formed = formed.unionByName(told)
    placed = with_row_number(formed, ["conv_id"], ["depth", "turn", "call_id", "line"], "position")
    return placed.select(
        "conv_id", F.col("position").cast("long").alias("position"), "call_id", "tool", "depth",
        "valid", "errors", "results", "line",
    )
