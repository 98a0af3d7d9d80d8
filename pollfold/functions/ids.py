"""Identities of responses and volunteers."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

def adler32(text: Column) -> Column:
    """Adler-32 of the UTF-8 bytes, as bigint; null stays null.

    Spark has no such checksum, and folding over the characters of a string in native expressions measured fifty times
    slower than this, so it is the one Arrow function here. Queries that do not use the id never run it.
    """

    @F.pandas_udf(LongType())
    def checksum(column: pd.Series) -> pd.Series:
        return column.map(lambda t: zlib.adler32(t.encode()), na_action="ignore").astype("Int64")

    return checksum(text)


def response_id(classification: Column, question: Column, response: Column, kind: str = "xxhash64") -> Column:
    """Id of one answer of one classification, as text.

    ``xxhash64`` is wide and native. ``adler32`` gives the ids of existing published tables; being a 32-bit sum without
    separators it collides on large tables.
    """
    if kind == "xxhash64":
        return F.xxhash64(classification, question, response).cast("string")
    if kind != "adler32":
        raise ValueError(f"unknown response id kind {kind!r}")
    parts = zip((classification, question, response), ("error_x", "error_y", "error_z"))
    return adler32(F.concat(*[F.coalesce(p, F.lit(missing)) for p, missing in parts])).cast("string")


def whole_number(text: Column) -> Column:
    """``290475.0`` and ``290475`` both as ``290475``; null when the text is not a number."""
    # a text with a point is no bigint, and to find that out by trying costs an exception a row
    exact = F.when(~F.contains(text, F.lit(".")), text.try_cast("bigint"))
    return F.coalesce(exact, text.try_cast("double").try_cast("bigint")).cast("string")


def person_id(user_id: Column, user_ip: Column) -> Column:
    """Volunteer identity: the account when there is one, else ``ip_`` + address, else null."""
    return F.coalesce(whole_number(user_id), F.concat(F.lit("ip_"), user_ip))


def account_or_address(user_id: Column, user_ip: Column) -> Column:
    """Volunteer identity as account number, or the bare address of visitors without account."""
    account = F.coalesce(whole_number(user_id), F.lit("0"))
    return F.when(account == "0", user_ip).otherwise(account)
