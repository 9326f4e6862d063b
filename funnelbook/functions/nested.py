"""Lists, tags, comments and nested JSON."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Alias order for the goal count of an ad group, first present one wins.
GOAL_ALIASES = ("base_vk_goals", "base_goals", "base_goal", "base_conversions")

COMMENTS_TYPE = "array<struct<comment:string>>"
TAGS_TYPE = "array<struct<category:string,type:string,names:array<string>>>"


def list_of_longs(c: Column) -> Column:
    """``[1,2]`` to an array; null for text that is no list."""
    return F.from_json(c, "array<bigint>")


def list_of_strings(c: Column) -> Column:
    """``['a','b']`` to an array. Either quote may enclose a text, the other may stand inside; enclosing quotes may be escaped."""
    read = lambda x: F.from_json(x, "array<string>", {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"})
    return F.coalesce(read(c), read(F.replace(c, F.lit("\\'"), F.lit("'"))))


def first_comment(comments: Column) -> Column:
    return F.coalesce(F.get(comments, F.lit(0)).getField("comment"), F.lit(""))


def _join_nonempty(values: Column) -> Column:
    return F.coalesce(F.array_join(F.filter(values, lambda v: v.isNotNull() & (v != "")), ", "), F.lit(""))


def tag_category(tags: Column) -> Column:
    return _join_nonempty(F.transform(tags, lambda t: t.getField("category")))


def tag_type(tags: Column) -> Column:
    return _join_nonempty(F.transform(tags, lambda t: t.getField("type")))


def tag_names(tags: Column) -> Column:
    present = F.filter(F.transform(tags, lambda t: t.getField("names")), lambda n: n.isNotNull())
    return _join_nonempty(F.flatten(present))


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """Every struct leaf becomes a top-level column named by its path. Driven by the schema, no action."""

    def leaves(struct: T.StructType, col: Column | None, path: str) -> Iterable[Column]:
        for f in struct.fields:
            here = F.col(f"`{f.name}`") if col is None else col.getField(f.name)
            name = f"{path}{sep}{f.name}" if path else f.name
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, here, name)
            else:
                yield here.alias(name)

    return df.select(*leaves(df.schema, None, ""))


def flatten_json(df: DataFrame, roots: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Columns ``<root>_<key>[_<key>..]`` read from JSON text columns, for a given target list.

    The key set may differ from row to row; no schema is discovered, each target is looked up. A key may itself contain ``_``,
    and inner objects may be nested or string-encoded, as deep as the target's name has parts; the shallowest value of a name wins. An
    empty inner object is kept as the text ``{}``.

    Every root is parsed once into a map of texts. The inner objects of a row, if it has any, are the texts in it that begin
    with a brace; they give the map of the next level, with their names put together. So the plan has one parse for each root and
    level, whatever the number of targets, and a row without inner objects is parsed once.
    """
    kept = [c for c in df.columns if c not in roots and c not in targets]
    wanted: dict[str, list[tuple[int, str]]] = {}
    for i, r in enumerate(roots):
        for t in targets:
            if t.startswith(f"{r}_"):
                wanted.setdefault(t, []).append((i, t[len(r) + 1:]))
    depth = {i: max(rest.count("_") + 1 for places in wanted.values() for j, rest in places if j == i) for i in {i for p in wanted.values() for i, _ in p}}
    carried = [F.col(f"`{c}`") for c in kept]
    out = df.select(*carried, *[_texts(F.col(roots[i])).alias(f"__m{i}_0") for i in depth])
    for level in range(1, max(depth.values(), default=1)):
        deeper = [i for i in depth if depth[i] > level]
        # a projection of its own for each level, so that a map is made once for all that refers to it
        out = out.select("*", *[_inner(F.col(f"__m{i}_{level - 1}")).alias(f"__m{i}_{level}") for i in deeper])

    def value(t: str) -> Column:
        places = sorted(((k, -len(roots[i]), i, rest) for i, rest in wanted.get(t, ()) for k in range(rest.count("_") + 1)))
        found = [F.col(f"__m{i}_{k}").getItem(rest) for k, _, i, rest in places]
        return (F.coalesce(*found) if found else F.lit(None).cast("string")).alias(t)

    return out.select(*carried, *[value(t) for t in targets])


def _texts(c: Column) -> Column:
    """A JSON object as a map of texts; inner objects are their own JSON text."""
    return F.from_json(c, "map<string,string>")


def _inner(texts: Column) -> Column:
    """The values of all inner objects, named by both keys. Of equal names the first counts; null if there are no inner objects."""
    objects = F.map_entries(F.map_filter(texts, lambda k, v: F.startswith(F.ltrim(v), F.lit("{"))))
    each = F.flatten(
        F.transform(objects, lambda o: F.transform(F.map_entries(F.coalesce(_texts(o["value"]), F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.concat_ws("_", o["key"], e["key"]).alias("k"), e["value"].alias("v"))))
    )
    names = F.transform(each, lambda e: e["k"])
    first = F.filter(each, lambda e, i: F.array_position(names, e["k"]) == i + 1)
    return F.when(F.exists(F.map_values(texts), lambda v: F.startswith(F.ltrim(v), F.lit("{"))), F.map_from_entries(first))


def coalesce_aliases(df: DataFrame, target: str, names: Sequence[str]) -> DataFrame:
    """``target`` = the first non-null of the listed columns that are present."""
    present = [F.col(n) for n in names if n in df.columns]
    return df.withColumn(target, F.coalesce(*present)) if present else df
