"""Landed response bodies: which are documents, what fields they hold, and their rows.

A body counts if it is one JSON object and nothing else. Others become rejects with a reason. Fields
need not be declared: they are discovered from all bodies by one merging aggregate over VARIANT values.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.casting import ColumnOrName, as_column

Path = tuple[str, ...]

#: Where a fulfillment response lists its services.
SERVICES = "$.data.product.fulfillment.shipping_options.services"

EMPTY, NOT_JSON, NOT_AN_OBJECT = "empty body", "not JSON", "not a JSON object"


def _alone(body: Column) -> tuple[Column, Column]:
    """The body as the only item of a list, and as the only field of an object: NULL if it can't be.

    A parser reads a document up to its end, whatever follows. What closes a list early doesn't close
    an object, and what adds an item doesn't add a field, so a body that is both is one document.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"k":'), body, F.lit("}")))
    return listed, named


def document(body: ColumnOrName) -> Column:
    """The body as a VARIANT; NULL unless it is one JSON object.

    A field given twice makes a body broken, unless the session allows it
    (``spark.sql.variant.allowDuplicateKeys``, which ``build_session`` sets): then the last one counts.
    """
    listed, named = _alone(as_column(body))
    is_object = F.schema_of_variant(named).startswith("OBJECT<k: OBJECT<")
    return F.when(is_object & listed.isNotNull(), F.try_variant_get(named, "$.k", "variant"))


def reject_reason(body: ColumnOrName) -> Column:
    """Why a body is no document; NULL if it is one."""
    text = as_column(body)
    listed, named = _alone(text)
    is_json = listed.isNotNull() & named.isNotNull()
    return (
        F.when(F.coalesce(F.trim(text, F.lit(" \t\r\n")) == "", F.lit(True)), EMPTY)
        .when(~is_json, NOT_JSON)
        .when(~F.schema_of_variant(named).startswith("OBJECT<k: OBJECT<"), NOT_AN_OBJECT)
    )


def rejects(df: DataFrame, body: str, lineage: Mapping[str, ColumnOrName]) -> DataFrame:
    """The bodies that give no row: lineage columns, ``reason``, ``body``."""
    return df.select(
        *[as_column(value).alias(name) for name, value in lineage.items()],
        reject_reason(body).alias("reason"),
        F.col(body).cast("string").alias("body"),
    ).where("reason IS NOT NULL")


_QUOTED_OR_OBJECT = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<")


def _spark_type(text: str | None) -> T.DataType:
    """The type that ``schema_of_variant`` spells; no rows have no fields."""
    if text is None:
        return T.StructType([])
    ddl = _QUOTED_OR_OBJECT.sub(lambda m: m[0] if m[0].startswith("`") else "STRUCT<", text)
    return T.DataType.fromDDL(ddl)


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    return kind.simpleString()


def _plain(kind: T.DataType) -> T.DataType | None:
    """The type a value is stored as; None where values of different kinds meet, which stay JSON text."""
    if isinstance(kind, T.DecimalType):
        return T.DoubleType() if kind.scale else T.DecimalType(38, 0)
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        element = _plain(kind.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(kind, T.StructType):
        fields = [(f.name, _plain(f.dataType)) for f in kind.fields]
        if not fields or any(k is None for _, k in fields):
            return None
        return T.StructType([T.StructField(n, k) for n, k in fields])
    return None if isinstance(kind, T.VariantType) else kind


def _merged(df: DataFrame, values: Mapping[str, Column]) -> dict[str, T.DataType]:
    """The type of each VARIANT column over all rows, objects only, in one aggregate."""
    objects = [
        F.schema_of_variant_agg(F.when(F.schema_of_variant(v).startswith("OBJECT<"), v)).alias(f"t{i}")
        for i, v in enumerate(values.values())
    ]
    found = df.agg(*objects).first()
    # An aggregate that saw no object says VOID.
    kinds = {name: _spark_type(None if found[i] == "VOID" else found[i]) for i, name in enumerate(values)}
    return {name: kind if isinstance(kind, T.StructType) else T.StructType([]) for name, kind in kinds.items()}


def _leaves(value: Column, kind: T.StructType, path: Path) -> Iterator[tuple[Path, Column, T.DataType]]:
    """(path, column, type) of every field that is no object, and of those that are not always one."""
    for field in kind.fields:
        here, own = (*path, field.name), value.getField(field.name)
        if isinstance(field.dataType, T.StructType) and field.dataType.fields:
            yield from _leaves(own, field.dataType, here)
        else:
            yield here, own, field.dataType


def _apart(kind: T.StructType, path: Path = ()) -> tuple[T.StructType, list[tuple[Path, T.DataType]]]:
    """The fields that a struct can tell apart by name, and those that differ from another in case only."""
    names = Counter(f.name.lower() for f in kind.fields)
    clear, alike = [], []
    for f in kind.fields:
        own, deep = f.dataType, []
        if names[f.name.lower()] > 1:
            alike.append(((*path, f.name), own))
            continue
        if isinstance(own, T.StructType) and own.fields:
            own, deep = _apart(own, (*path, f.name))
        if not isinstance(own, T.StructType) or own.fields:
            clear.append(T.StructField(f.name, own))
        alike += deep
    return T.StructType(clear), alike


def _json_path(steps: Path) -> str:
    quote = lambda step: "'" if "'" not in step else '"'
    return "$" + "".join(f"[{quote(s)}{s}{quote(s)}]" for s in steps)


def _fields(value: Column, kind: T.StructType, path: Path) -> Iterator[tuple[Path, Column, T.DataType]]:
    """``_leaves`` of a VARIANT, whatever the case of its fields."""
    clear, alike = _apart(kind)
    if clear.fields:
        yield from _leaves(F.try_variant_get(value, "$", _ddl(clear)), clear, path)
    for steps, own_kind in alike:
        own = F.try_variant_get(value, _json_path(steps), "variant")
        if isinstance(own_kind, T.StructType) and own_kind.fields:
            yield from _fields(own, own_kind, (*path, *steps))
        else:
            yield (*path, *steps), F.try_variant_get(own, "$", _ddl(own_kind)), own_kind


def _kept_whole(kind: T.DataType) -> T.DataType:
    """The same fields, with VARIANT for every value that has no plain type; objects stay objects."""
    if isinstance(kind, T.StructType) and kind.fields:
        return T.StructType([T.StructField(f.name, _kept_whole(f.dataType)) for f in kind.fields])
    return _plain(kind) or T.VariantType()


def _columns(df: DataFrame, roots: Mapping[str, Column]) -> dict[str, list[Column]]:
    """Flat columns of VARIANT objects by normalised name; ``roots`` maps a name's prefix to its object.

    A field that is an object in some rows and something else in others gives its sub-fields and a
    column of its own for the rest; each level of such fields costs one more aggregate.
    """
    found: dict[str, list[Column]] = {}
    open_: dict[Path, Column] = {(prefix,) if prefix else (): value for prefix, value in roots.items()}
    while open_:
        kinds = _merged(df, {str(i): v for i, v in enumerate(open_.values())})
        following: dict[Path, Column] = {}
        for i, (path, value) in enumerate(open_.items()):
            kind = _kept_whole(kinds[str(i)])
            if not isinstance(kind, T.StructType):
                continue
            for here, own, own_kind in _fields(value, kind, path):
                if isinstance(own_kind, T.VariantType):
                    spelled = F.schema_of_variant(own)
                    following[here] = own
                    scalar = F.when(~spelled.rlike("^(OBJECT|ARRAY)<"), F.try_variant_get(own, "$", "string"))
                    own = F.coalesce(scalar, F.when(~spelled.rlike("^(OBJECT<[^>]|VOID)"), F.to_json(own)))
                name = "_".join(here).lower().replace(".", "_")
                found.setdefault(name, []).append(own)
        open_ = following
    return found


def _one(columns: list[Column], df: DataFrame) -> Column:
    """Fields whose names fall together: the first that is known, as text if their types differ."""
    if len(columns) == 1:
        return columns[0]
    types = {f.dataType.simpleString() for f in df.select(*[c.alias(str(i)) for i, c in enumerate(columns)]).schema}
    if len(types) == 1:
        return F.coalesce(*columns)
    return F.coalesce(*[c.cast("string") for c in columns])


def discovered_rows(
    df: DataFrame, body: str, lineage: Mapping[str, ColumnOrName], services: str = SERVICES
) -> DataFrame:
    """Responses to flat rows of all their fields, declared nowhere: one per service, or one without any.

    Objects become columns named by their path (lower case, '_' between steps and for '.'); lists stay
    lists. A column's type is the one its values of all rows merge to: numbers with digits behind the
    point are doubles, values of different kinds are text (JSON text for lists and objects among
    them). ``lineage`` columns replace fields of the same name. Bodies that are no JSON object give
    none (see ``rejects``); a services value that is no list, or an empty one, gives one row without
    service fields. Runs one aggregate over ``df`` to discover the fields.
    """
    taken = [as_column(value).alias(name) for name, value in lineage.items()]
    docs = df.select(*taken, document(body).alias("_doc")).where("_doc IS NOT NULL")
    listed = F.try_variant_get("_doc", services, "array<variant>")
    rows = docs.select("*", F.explode_outer(listed).alias("_item"))
    found = _columns(rows, {"": F.col("_doc"), "services": F.col("_item")})
    own = set(lineage)
    return rows.select(
        *[F.col(f"`{name}`") for name in lineage],
        *[_one(columns, rows).alias(name) for name, columns in found.items() if name not in own],
    )
