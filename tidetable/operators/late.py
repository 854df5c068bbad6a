"""Late and out-of-order events: the event-period by arrival-period triangle, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

TRIANGLE = """
SELECT {keys}, period_start, arrival_period, count(*) AS arrived
FROM (
  SELECT {keys}, CAST(floor(event_s / {length}) * {length} AS BIGINT) AS period_start,
         -- arrivals before the period's end fall into cell 0, those of (end + (k - 1) * step, end + k * step] into cell k
         greatest(0, CAST(ceil((first_us - (floor(event_s / {length}) + 1) * {length} * 1000000) / ({step} * 1000000.0)) AS BIGINT)) AS arrival_period,
         first_us <= ((floor(event_s / {length}) + 1) * {length} + {cutoff}) * 1000000 AS in_time
  FROM (
    -- one record however often it is delivered; it arrives with its first delivery
    SELECT {keys}, record, event_s, min(arrival_us) AS first_us
    FROM {records}
    WHERE event_s IS NOT NULL AND arrival_us IS NOT NULL
    GROUP BY {keys}, record, event_s
  )
)
WHERE in_time
GROUP BY {keys}, period_start, arrival_period
"""

REVISIONS = """
SELECT {keys}, period_start, arrival_period, arrived,
       sum(arrived) OVER (PARTITION BY {keys}, period_start ORDER BY arrival_period ROWS UNBOUNDED PRECEDING) AS total,
       row_number() OVER (PARTITION BY {keys}, period_start ORDER BY arrival_period) AS revision,
       arrival_period = max(arrival_period) OVER (PARTITION BY {keys}, period_start) AS is_final
FROM {triangle}
"""

CORRECTED = """
SELECT {keys}, period_start, coalesce(max(CASE WHEN arrival_period <= {after} THEN total END), 0) AS first_total, max(total) AS final_total
FROM {revisions}
GROUP BY {keys}, period_start
HAVING max(total) > coalesce(max(CASE WHEN arrival_period <= {after} THEN total END), 0)
"""


def triangle(records: DataFrame, keys: str, length: int, step: int, cutoff: int) -> DataFrame:
    """Counts of distinct records by event period and arrival period.

    ``records`` holds the key columns (``keys``, separated by commas), ``record`` (identity within the keys), ``event_s``
    (epoch seconds) and ``arrival_us`` (epoch microseconds). Records without event time or arrival do not count; null
    keys and identities are values. Arrivals more than ``cutoff`` seconds after the period's end are left out, whether or not
    ``step`` divides the cut-off. All aggregations combine before shuffling, and a period has at most ``cutoff / step + 2`` cells.
    """
    return records.sparkSession.sql(TRIANGLE.format(keys=keys, length=int(length), step=int(step), cutoff=int(cutoff), records="{records}"), records=records)


def revisions(cells: DataFrame, keys: str) -> DataFrame:
    """Every corrected count of every period: ``total`` after each arrival period with news, numbered by ``revision``."""
    return cells.sparkSession.sql(REVISIONS.format(keys=keys, triangle="{triangle}"), triangle=cells)


def corrected(revised: DataFrame, keys: str, after: int) -> DataFrame:
    """Periods of :func:`revisions` whose count changed after arrival period ``after``: ``first_total``, the count that stood then (0 without
    arrivals), and ``final_total``, the one at the cut-off."""
    return revised.sparkSession.sql(CORRECTED.format(keys=keys, after=int(after), revisions="{revised}"), revised=revised)
