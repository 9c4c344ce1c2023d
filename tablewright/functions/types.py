"""Declared column types and their Spark and standard SQL spellings."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

from tablewright.errors import ConfigError

#: Spellings of each base type; (precision, scale) where the spelling implies them.
SPELLINGS = {
    "STRING": ["string", "str", "text"],
    "INTEGER": ["int", "integer"],
    "BIGINT": ["bigint", "long"],
    "SMALLINT": ["smallint"],
    "TINYINT": ["tinyint", "byte"],
    "DOUBLE": ["double"],
    "FLOAT": ["float", "real"],
    "DECIMAL": ["decimal", "numeric", "number", "money", "smallmoney"],
    "DATE": ["date"],
    "TIMESTAMP": ["timestamp", "datetime", "datetime2"],
    "BOOLEAN": ["boolean", "bool", "bit"],
    "BINARY": ["binary", "varbinary"],
}
IMPLIED = {"money": (19, 4), "smallmoney": (10, 4)}
#: Spellings that must have, or may have, arguments.
SIZED_TEXT = {"varchar", "char", "character"}
SPARK_TYPES = {
    "STRING": T.StringType(), "INTEGER": T.IntegerType(), "BIGINT": T.LongType(), "SMALLINT": T.ShortType(), "TINYINT": T.ByteType(), "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(), "BOOLEAN": T.BooleanType(), "BINARY": T.BinaryType(),
}
_BASE = {word: base for base, words in SPELLINGS.items() for word in words}


@dataclass(frozen=True)
class TypeSpec:
    base_type: str
    precision: int | None = None
    scale: int | None = None

    def spark_type(self) -> T.DataType:
        """A bare DECIMAL is DECIMAL(10,0); a text's length isn't enforced."""
        if self.base_type == "DECIMAL":
            return T.DecimalType(self.precision or 10, self.scale or 0)
        return SPARK_TYPES[self.base_type]

    def to_spark_sql(self) -> str:
        if self.base_type == "DECIMAL":
            return f"DECIMAL({self.precision or 10},{self.scale or 0})"
        return self.base_type

    def to_standard_sql(self) -> str:
        name = {"STRING": "VARCHAR", "INTEGER": "INT", "BINARY": "VARBINARY"}.get(self.base_type, self.base_type)
        sizes = [str(x) for x in (self.precision, self.scale) if x is not None]
        return f"{name}({','.join(sizes)})" if sizes else name


def parse_type(text: str) -> TypeSpec:
    """The type that a declaration names, whatever its case and spacing."""
    m = re.fullmatch(r"\s*([a-z0-9]+)\s*(?:\(([^()]*)\))?\s*", str(text).lower())
    if not m:
        raise ConfigError(f"not a type: {text!r}")
    word, arguments = m[1], m[2]
    sizes = None if arguments is None else [x.strip() for x in arguments.split(",")]
    if sizes is not None and not all(x.isdigit() for x in sizes):
        raise ConfigError(f"{text!r}: sizes must be whole numbers")
    numbers = [int(x) for x in sizes or []]
    if word in SIZED_TEXT or word == "varbinary" and numbers:
        if len(numbers) != 1 or numbers[0] < 1:
            raise ConfigError(f"{text!r}: one positive length is needed")
        return TypeSpec("BINARY" if word == "varbinary" else "STRING", numbers[0])
    if word not in _BASE:
        raise ConfigError(f"unknown type {text!r}")
    base = _BASE[word]
    if word in IMPLIED:
        if numbers:
            raise ConfigError(f"{text!r}: takes no sizes")
        return TypeSpec(base, *IMPLIED[word])
    if not numbers:
        return TypeSpec(base)
    if base == "BINARY" and len(numbers) == 1 and numbers[0] > 0:
        return TypeSpec(base, numbers[0])
    if base != "DECIMAL" or len(numbers) > 2:
        raise ConfigError(f"{text!r}: {word} takes no such sizes")
    precision, scale = numbers[0], numbers[1] if len(numbers) == 2 else 0
    if not 0 < precision <= 38 or scale > precision:
        raise ConfigError(f"{text!r}: needs 0 < precision <= 38 and scale <= precision")
    return TypeSpec(base, precision, scale)
