"""DataFrame operators. Operators that refuse rows return ``Outcome``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame


class Outcome(NamedTuple):
    """Accepted rows, and refused rows with a ``reason`` column."""

    accepted: DataFrame
    rejected: DataFrame
