"""Column expressions shared by the jobs (all JVM-side, codegen-friendly)."""

from plover.functions.columns import (  # noqa: F401
    blank_to_null,
    epoch_ms,
    geohash,
    ip_to_long,
    is_blank,
    long_to_ip,
    not_blank,
)
