"""Consumer queries over the momentum and volatility views.

Every limit is ordered down to the symbol, so equal values give equal results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def presented(df: DataFrame, digits: int = 4) -> DataFrame:
    """Percentage columns rounded for display; stored tables stay unrounded."""
    rounded = {c: F.round(c, digits) for c in df.columns if c.startswith("pct_change_")}
    return df.withColumns(rounded) if rounded else df


def top_momentum(momentum: DataFrame, ranks: int = 10) -> DataFrame:
    return (
        momentum.where(F.col("momentum_rank") <= ranks)
        .select("symbol", "name", "pct_change_24h", "momentum_rank")
        .orderBy("momentum_rank", "symbol")
    )


def change_distribution(momentum: DataFrame, ranks: int = 20) -> DataFrame:
    return momentum.where(F.col("momentum_rank") <= ranks).select("symbol", "pct_change_24h")


def top_market_cap(momentum: DataFrame, n: int = 20) -> DataFrame:
    return (
        momentum.select("symbol", "name", "market_cap_usd")
        .orderBy(F.col("market_cap_usd").desc(), "symbol")
        .limit(n)
    )


def top_gainers(momentum: DataFrame, n: int = 5) -> DataFrame:
    return (
        momentum.select("symbol", "name", "pct_change_24h")
        .orderBy(F.col("pct_change_24h").desc(), "symbol")
        .limit(n)
    )


def most_volatile(volatility: DataFrame, n: int = 10) -> DataFrame:
    return (
        volatility.select("symbol", "realized_volatility_7d", "n_observations")
        .orderBy(F.col("realized_volatility_7d").desc(), "symbol")
        .limit(n)
    )


def price_lookup(momentum: DataFrame, symbol: str) -> DataFrame:
    """Current price of one symbol, in any letter case, as a bound parameter."""
    return momentum.sparkSession.sql(
        """
        SELECT symbol, price_usd, pct_change_24h, observed_at
        FROM {momentum}
        WHERE upper(symbol) = upper(:symbol)
        """,
        args={"symbol": symbol},
        momentum=momentum,
    )


def movers(momentum: DataFrame) -> DataFrame:
    """How many symbols went up, went down, stayed, or have no 24-hour change."""
    change = F.col("pct_change_24h")
    return momentum.agg(
        F.count_if(change > 0).alias("gainers"),
        F.count_if(change < 0).alias("losers"),
        F.count_if(change == 0).alias("unchanged"),
        F.count_if(change.isNull()).alias("unknown"),
    )


def rescued_sample(lineage: DataFrame, n: int = 5) -> DataFrame:
    """A look at unexpected fields after a change of the feed."""
    return lineage.where("_rescued_data IS NOT NULL").select("_rescued_data").limit(n)
