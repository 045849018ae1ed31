"""Uniform access to record fields: typed columns, or one VARIANT column.

A field knows whether its key is there, its value as a string if it is one, its
truth as a dynamic language sees it, and its value as a number.  Typed tables
cannot tell an absent key from null: both count as absent there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE = "array<struct<role:string,content:string,has_call:boolean>>"


def none(kind: str) -> Column:
    return F.lit(None).cast(kind)


class Fields:
    """Fields of a DataFrame's rows; `put` overlays a string field with an expression."""

    def __init__(self) -> None:
        self.over: dict[str, Column] = {}

    def put(self, name: str, value: Column) -> None:
        """From now on `name` is this string; where it is null, what it was before."""
        self.over[name] = value if name not in self.over else F.coalesce(value, self.over[name])

    def string(self, name: str) -> Column:
        return F.coalesce(self.over[name], self._string(name)) if name in self.over else self._string(name)

    def present(self, name: str) -> Column:
        return self.over[name].isNotNull() | self._present(name) if name in self.over else self._present(name)

    def truthy(self, name: str) -> Column:
        """False for absent, null, false, 0, empty strings, arrays and objects."""
        if name not in self.over:
            return self._truthy(name)
        return F.when(self.over[name].isNotNull(), F.length(self.over[name]) > 0).otherwise(self._truthy(name))

    def shown(self, name: str) -> Column:
        """The value as a string where it is true, else null."""
        return F.when(self.truthy(name), F.coalesce(self.over[name], self._shown(name)) if name in self.over else self._shown(name))

    def first(self, *names: str, default: str | None = None) -> Column:
        """The first true value as a string."""
        out = [self.shown(n) for n in names]
        return F.coalesce(*out, F.lit(default)) if default is not None else F.coalesce(*out, none("string"))


class ColumnFields(Fields):
    def __init__(self, df: DataFrame):
        super().__init__()
        self.kinds = {f.name: f.dataType for f in df.schema.fields}

    def _has(self, name: str) -> bool:
        top, _, rest = name.partition(".")
        kind = self.kinds.get(top)
        return kind is not None and (not rest or isinstance(kind, T.StructType) and rest in kind.names)

    def _kind(self, name: str):
        top, _, rest = name.partition(".")
        return self.kinds[top][rest].dataType if rest else self.kinds[top]

    def _present(self, name: str) -> Column:
        return F.col(name).isNotNull() if self._has(name) else F.lit(False)

    def _string(self, name: str) -> Column:
        return F.col(name) if self._has(name) and isinstance(self._kind(name), T.StringType) else none("string")

    def _shown(self, name: str) -> Column:
        return F.col(name).cast("string") if self._has(name) else none("string")

    def _truthy(self, name: str) -> Column:
        if not self._has(name):
            return F.lit(False)
        c, kind = F.col(name), self._kind(name)
        if isinstance(kind, T.BooleanType):
            out = c
        elif isinstance(kind, T.StringType):
            out = F.length(c) > 0
        elif isinstance(kind, T.NumericType):
            out = c != 0
        elif isinstance(kind, (T.ArrayType, T.MapType)):
            out = F.size(c) > 0
        else:
            out = c.isNotNull()
        return F.coalesce(out, F.lit(False))

    def boolean(self, name: str) -> Column:
        """The value if it is a boolean."""
        return F.col(name) if self._has(name) and isinstance(self._kind(name), T.BooleanType) else none("boolean")

    def number(self, name: str) -> Column:
        """A number, or a string that reads as one; booleans are none."""
        if not self._has(name):
            return none("double")
        kind = self._kind(name)
        if isinstance(kind, T.NumericType):
            return F.col(name).cast("double")
        if isinstance(kind, T.StringType):
            return read_number(F.col(name))
        return none("double")

    def plain_number(self, name: str) -> Column:
        """A number that is no string; booleans count as 0 and 1."""
        if self._has(name) and isinstance(self._kind(name), (T.NumericType, T.BooleanType)):
            return F.col(name).cast("double")
        return none("double")

    def strings(self, name: str) -> Column:
        """The value as array<string> if it is an array."""
        if self._has(name) and isinstance(self._kind(name), T.ArrayType):
            return F.transform(F.col(name), lambda x: x.cast("string"))
        return none("array<string>")

    def messages(self, *names: str) -> Column:
        """The first non-empty list of messages, in the form MESSAGE."""
        out = [none(MESSAGE)]
        for name in names:
            if not self._has(name) or not isinstance(self._kind(name), T.ArrayType) or not isinstance(self._kind(name).elementType, T.StructType):
                continue
            parts = self._kind(name).elementType
            get = lambda m, k: m[k] if k in parts.names else none("string")

            def call(m: Column, parts=parts) -> Column:
                if "tool_calls" not in parts.names:
                    return F.lit(False)
                kind = parts["tool_calls"].dataType
                c = m["tool_calls"]
                return F.coalesce(F.size(c) > 0 if isinstance(kind, (T.ArrayType, T.MapType)) else F.length(c.cast("string")) > 0, F.lit(False))

            value = F.transform(F.filter(F.col(name), lambda m: m.isNotNull()), lambda m: F.struct(get(m, "role").alias("role"), get(m, "content").alias("content"), call(m).alias("has_call")))
            out.insert(-1, F.when(F.size(F.col(name)) > 0, value))
        return F.coalesce(*out)


class VariantFields(Fields):
    """Fields of a VARIANT column, as `parse_json` makes of a JSON object."""

    def __init__(self, column: str):
        super().__init__()
        self.column = column

    def _get(self, name: str, kind: str = "variant") -> Column:
        return F.try_variant_get(F.col(self.column), "$." + name, kind)

    def _type(self, name: str) -> Column:
        return F.schema_of_variant(self._get(name))

    def _present(self, name: str) -> Column:
        return self._get(name).isNotNull()

    def _is(self, name: str, pattern: str) -> Column:
        return F.coalesce(self._type(name).rlike(pattern), F.lit(False))

    def _string(self, name: str) -> Column:
        return F.when(self._is(name, "^STRING$"), self._get(name, "string"))

    def _shown(self, name: str) -> Column:
        return self._get(name, "string")

    def _truthy(self, name: str) -> Column:
        text = F.to_json(self._get(name))
        return F.coalesce(~text.isin("null", "false", '""', "[]", "{}") & ~F.coalesce(self._is(name, "^(BIGINT|DOUBLE|DECIMAL.*)$") & (self._get(name, "double") == 0), F.lit(False)), F.lit(False))

    def boolean(self, name: str) -> Column:
        return F.when(self._is(name, "^BOOLEAN$"), self._get(name, "boolean"))

    def number(self, name: str) -> Column:
        return F.when(self._is(name, "^(BIGINT|DOUBLE|DECIMAL.*)$"), self._get(name, "double")).when(self._is(name, "^STRING$"), read_number(self._get(name, "string")))

    def plain_number(self, name: str) -> Column:
        return F.when(self._is(name, "^(BIGINT|DOUBLE|DECIMAL.*|BOOLEAN)$"), self._get(name, "double"))

    def strings(self, name: str) -> Column:
        return F.when(self._is(name, "^ARRAY"), self._get(name, "array<string>"))

    def messages(self, *names: str) -> Column:
        out = []
        for name in names:
            items = F.filter(self._get(name, "array<variant>"), lambda m: F.schema_of_variant(m).startswith("OBJECT"))
            one = lambda m, k: F.when(F.schema_of_variant(F.try_variant_get(m, f"$.{k}", "variant")) == "STRING", F.try_variant_get(m, f"$.{k}", "string"))
            call = lambda m: F.coalesce(~F.to_json(F.try_variant_get(m, "$.tool_calls", "variant")).isin("null", "false", '""', "[]", "{}", "0"), F.lit(False))
            value = F.transform(items, lambda m: F.struct(one(m, "role").alias("role"), one(m, "content").alias("content"), call(m).alias("has_call")))
            out.append(F.when(F.size(self._get(name, "array<variant>")) > 0, value))
        return F.coalesce(*out, none(MESSAGE))


def read_number(c: Column) -> Column:
    """A string as a double; digits may be grouped by single underscores; blank or other text is null."""
    trimmed = F.regexp_replace(F.trim(c), r"(?<=\d)_(?=\d)", "")
    return F.when(trimmed.rlike(r"(?i)^[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)$"), trimmed.try_cast("double"))
