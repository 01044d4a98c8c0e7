"""Big-endian decode and encode of scalar keys and values."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Bytes per scalar type.
WIDTHS = {"short": 2, "int": 4, "float": 4, "long": 8, "double": 8}


def _number(hex_text: Column, to: str) -> Column:
    return F.conv(hex_text, 16, 10).cast(to)


def _integer(value: Column, width: int) -> Column:
    bits = 8 * width
    unsigned = _number(F.hex(value), "decimal(20,0)")
    limit = F.lit(str(2 ** (bits - 1))).cast("decimal(20,0)")
    span = F.lit(str(2 ** bits)).cast("decimal(20,0)")
    return F.when(unsigned >= limit, unsigned - span).otherwise(unsigned).cast("bigint")


def _ieee(value: Column, head_digits: int, exponent_values: int, mantissa_bits: int) -> Column:
    """Rebuild a float from sign, exponent and mantissa; every step is exact in a double."""
    bits = F.hex(value)
    if head_digits:
        head = _number(F.substring(bits, 1, head_digits), "bigint")
        mantissa = _number(F.substring(bits, head_digits + 1, 16), "bigint")
    else:
        whole = _number(bits, "bigint")
        head = F.shiftright(whole, mantissa_bits)
        mantissa = whole.bitwiseAND(F.lit(2 ** mantissa_bits - 1))
    sign = F.when(head >= exponent_values, F.lit(-1.0)).otherwise(F.lit(1.0))
    exponent = head % exponent_values
    bias = exponent_values // 2 - 1 + mantissa_bits
    normal = (mantissa + F.lit(2 ** mantissa_bits)).cast("double") * F.pow(F.lit(2.0), exponent - bias)
    small = mantissa.cast("double") * F.pow(F.lit(2.0), F.lit(1 - bias))
    special = F.when(mantissa == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return sign * (F.when(exponent == exponent_values - 1, special).when(exponent == 0, small).otherwise(normal))


def decode_binary(value: Column, kind: str) -> Column:
    """Bytes to a scalar; null stays null, a wrong length raises."""
    if kind == "string":
        return F.decode(value, "UTF-8")
    width = WIDTHS[kind]
    decoded = {
        "short": lambda: _integer(value, 2).cast("short"),
        "int": lambda: _integer(value, 4).cast("int"),
        "long": lambda: _integer(value, 8),
        "float": lambda: _ieee(value, 0, 256, 23).cast("float"),
        "double": lambda: _ieee(value, 3, 2048, 52),
    }[kind]()
    wrong = F.raise_error(F.concat(F.lit(f"{kind} needs {width} bytes, got "), F.octet_length(value).cast("string")))
    return F.when(value.isNull(), F.lit(None)).when(F.octet_length(value) == width, decoded).otherwise(wrong)


def encode_binary(value: Column, kind: str) -> Column:
    """Scalar to its big-endian bytes; null stays null."""
    if kind == "string":
        return F.encode(value, "UTF-8")
    if kind in ("float", "double"):
        dtype = ">f4" if kind == "float" else ">f8"

        @F.pandas_udf("binary")
        def pack(numbers: pd.Series) -> pd.Series:
            width = int(dtype[-1])
            raw = numbers.to_numpy(dtype=dtype, na_value=0.0).tobytes()
            cut = pd.Series([raw[i:i + width] for i in range(0, len(raw), width)], dtype=object)
            return cut

        return F.when(value.isNotNull(), pack(value))
    digits = 2 * WIDTHS[kind]
    return F.unhex(F.right(F.lpad(F.hex(value.cast("bigint")), 16, "0"), F.lit(digits)))
