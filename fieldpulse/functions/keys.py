"""Keys of the latest-state and analytics views, and the reverse (device from key)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldpulse.constants import KEY_PREFIX


def build_key_state(env: Column, tenant: Column, device: Column, prefix: str = KEY_PREFIX) -> Column:
    # concat, not concat_ws: a null part makes the whole key null, as in the reference
    return F.concat(F.lit(prefix + ":"), env, F.lit(":"), tenant, F.lit(":device:"), device,
                    F.lit(":state"))


def build_key_streak(env: Column, tenant: Column, device: Column, prefix: str = KEY_PREFIX) -> Column:
    return F.concat(F.lit(prefix + ":"), env, F.lit(":"), tenant, F.lit(":device:"), device,
                    F.lit(":humidity_low_streak"))


def build_key_summary(env: Column, tenant: Column) -> Column:
    return F.concat(env, F.lit(":"), tenant)


def _between(key: Column, suffix: str) -> Column:
    """Text between the first ':device:' and the last ``suffix``; null if either is missing
    or the text between them is empty."""
    start = F.instr(key, ":device:")
    # last occurrence of the suffix: search the reversed string
    rev_pos = F.instr(F.reverse(key), suffix[::-1])
    end = F.length(key) - rev_pos - F.lit(len(suffix)) + 2
    ok = (start > 0) & (rev_pos > 0) & (end - 1 > start + 7)
    return F.when(ok, key.substr(start + 8, end - start - 8))


def device_from_state_key(key: Column) -> Column:
    return _between(key, ":state")


def device_from_streak_key(key: Column) -> Column:
    return _between(key, ":humidity_low_streak")


def _literal(text: str) -> str:
    """Text as part of a LIKE pattern that matches only itself."""
    return "".join("\\" + c if c in "\\%_" else c for c in text)


def state_key_pattern(env: str, tenant: str, prefix: str = KEY_PREFIX) -> str:
    """SQL LIKE pattern of a tenant's device-state keys."""
    return _literal(f"{prefix}:{env}:{tenant}:device:") + "%:state"


def streak_key_pattern(env: str, tenant: str, prefix: str = KEY_PREFIX) -> str:
    return _literal(f"{prefix}:{env}:{tenant}:device:") + "%" + _literal(":humidity_low_streak")
