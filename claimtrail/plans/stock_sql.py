"""SQL that follows a patient's supply day by day: what the checking queries of the fill histories are made of."""

from __future__ import annotations


def stock_sql(daily: str, name: str) -> str:
    """CTE ``name``: for each calendar day from a patient's first to last fill in ``daily`` (enrolid, svcdate, d) the supply received that
    day (``got``), in stock in the morning (``held``) and in the evening (``kept``). A day with any stock uses one day's supply.

    The running sum of receipts less one a day falls below its lowest value so far on exactly the days without stock.
    """
    return f"""{name}_calendar AS (SELECT enrolid, CAST(unnest(generate_series(min(svcdate), max(svcdate), INTERVAL 1 DAY)) AS DATE) AS day FROM {daily} GROUP BY 1),
{name}_sum AS (SELECT c.enrolid, day, coalesce(d, 0) AS got, sum(coalesce(d, 0) - 1) OVER (PARTITION BY c.enrolid ORDER BY day) AS net
 FROM {name}_calendar c LEFT JOIN {daily} f ON f.enrolid = c.enrolid AND f.svcdate = c.day),
{name}_kept AS (SELECT enrolid, day, got, CAST(net - least(0, min(net) OVER (PARTITION BY enrolid ORDER BY day)) AS INT) AS kept FROM {name}_sum),
{name} AS (SELECT *, coalesce(lag(kept) OVER (PARTITION BY enrolid ORDER BY day), 0) AS held FROM {name}_kept)"""


def ends_sql(stock: str, name: str, gap: int = 60) -> str:
    """CTE ``name``: the first day without supply (``supply_end``), before the first run of over ``gap`` such days or else after the last fill."""
    return f"""{name}_dry AS (SELECT enrolid, day, day - CAST(row_number() OVER (PARTITION BY enrolid ORDER BY day) AS INT) AS run FROM {stock} WHERE got + held = 0),
{name}_runs AS (SELECT enrolid, min(day) AS since FROM {name}_dry GROUP BY enrolid, run HAVING count(*) > {gap}),
{name}_stops AS (SELECT enrolid, min(since) AS since FROM {name}_runs GROUP BY 1),
{name} AS (SELECT enrolid, min(day) AS first_day, coalesce(any_value(since), max(day) + arg_max(kept, day) + 1) AS supply_end, any_value(since) IS NOT NULL AS stopped
 FROM {stock} LEFT JOIN {name}_stops USING (enrolid) GROUP BY 1)"""


def covered_sql(daily: str, name: str, end: str) -> str:
    """CTE ``name``: the number of different calendar days before ``end`` that a patient's fills in ``daily`` cover."""
    return f"""{name}_days AS (SELECT enrolid, unnest(generate_series(svcdate, least(svcdate + d, {end}) - 1, INTERVAL 1 DAY)) AS day FROM {daily}),
{name} AS (SELECT f.enrolid, coalesce(any_value(n), 0) AS covered FROM {daily} f
 LEFT JOIN (SELECT enrolid, count(DISTINCT day) AS n FROM {name}_days GROUP BY 1) c ON c.enrolid = f.enrolid GROUP BY 1)"""
