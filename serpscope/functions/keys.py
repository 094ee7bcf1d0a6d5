"""Deterministic keys and the values derived from them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from serpscope import schema as S


def text_or_none(col: Column) -> Column:
    """Nulls take part in keys as the text 'None' instead of nulling the whole key."""
    return F.coalesce(col.cast("string"), F.lit("None"))


def surrogate_key(*cols: str) -> Column:
    return F.md5(F.concat_ws("_", *[text_or_none(F.col(c)) for c in cols]))


def query_key() -> Column:
    return surrogate_key(*S.QUERY_ATTRS)


def user_key(col: str = "user_id_masked") -> Column:
    return surrogate_key(col)


def hash_bucket(col: Column) -> Column:
    """First 8 hex digits of md5 as an unsigned 32-bit integer."""
    return F.conv(F.substring(F.md5(col.cast("string")), 1, 8), 16, 10).cast("bigint")


def pick(values: list[str], index: Column) -> Column:
    """Member of a short fixed list selected by index modulo its length."""
    members = F.array(*[F.lit(v) for v in values])
    return F.element_at(members, (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def profile_columns(bucket: Column) -> dict[str, Column]:
    """Reproducible user profile from the id hash."""
    base = F.lit(S.SIGNUP_BASE).cast("timestamp_ntz")
    days = F.pmod(bucket, F.lit(S.SIGNUP_SPREAD_DAYS)).cast("int")
    return {
        "gender": pick(S.GENDERS, bucket),
        "age": (F.pmod(bucket, F.lit(50)) + 18).cast("int"),
        "signup_channel": pick(S.SIGNUP_CHANNELS, bucket),
        "signup_timestamp": base + F.make_dt_interval(days=days),
        "user_segment": pick(S.USER_SEGMENTS, bucket),
    }


def mask_pii(col: Column, salt: str) -> Column:
    """Salted SHA-256, for user ids and addresses."""
    return F.sha2(F.concat(F.lit(salt), col.cast("string")), 256)
