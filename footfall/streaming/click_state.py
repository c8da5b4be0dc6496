"""Per-user state of the ad-click filter.

One state per user holds whether the user is listed and, until then, the
running clicks per (day, ad). A micro-batch therefore touches the state of its
own users and nothing else: no table is read back, however long the day is.

The state step sees counts, never clicks: every task first counts its clicks per
(user, day, ad) (``task_counts``), so a user with a third of the log reaches the one
group of that user as a few rows for each task.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa

# One output row is a (day, ad) count of the batch with its running total (kind 1), a user
# listed by the batch (kind 2), or a user of the batch whom an earlier batch listed
# (kind 3); of the last two only the user counts. Clicks (kind 0) join them afterwards.
CLICK, COUNT, LISTED, BARRED = 0, 1, 2, 3
OUTPUT_SCHEMA = "kind INT, user_id BIGINT, ad_id BIGINT, date DATE, click_count BIGINT, total BIGINT"
OUTPUT_COLUMNS = [c.split()[0] for c in OUTPUT_SCHEMA.split(", ")]
STATE_SCHEMA = "listed BOOLEAN, counts STRING"
CLICK_COLUMNS = ["ts_ms", "province", "city", "user_id", "ad_id", "click_time", "date", "date_key"]
COUNT_KEY = ["user_id", "date", "ad_id"]
COUNTS_SCHEMA = "user_id BIGINT, date DATE, ad_id BIGINT, click_count BIGINT"

# Keys that a task holds before it hands its counts on.
HELD_KEYS = 100_000
NO_DAY = datetime.date(1970, 1, 1)      # in rows of which only the user counts


def task_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clicks per (user, day, ad) of one task. Partial counts are merged while they have
    at most ``HELD_KEYS`` keys, so a key may come out more than once and memory stays bounded."""
    held = None
    for b in batches:
        made = pa.Table.from_batches([b]).select(COUNT_KEY).group_by(COUNT_KEY).aggregate([([], "count_all")])
        made = made.rename_columns([*COUNT_KEY, "n"])
        if held is not None:
            made = pa.concat_tables([held, made]).group_by(COUNT_KEY).aggregate([("n", "sum")])
            made = made.rename_columns([*COUNT_KEY, "n"])
        held = made
        if held.num_rows > HELD_KEYS:
            yield from _out(held)
            held = None
    if held is not None:
        yield from _out(held)


def _out(counts: pa.Table) -> list[pa.RecordBatch]:
    return counts.rename_columns([*COUNT_KEY, "click_count"]).combine_chunks().to_batches()


def _frame(user, keys: list, kinds: list, made: list, totals: list) -> pd.DataFrame:
    """All rows of one user at once: a frame costs more than its rows."""
    return pd.DataFrame({"kind": kinds, "user_id": user, "ad_id": [a for _, a in keys],
                         "date": [d for d, _ in keys], "click_count": made, "total": totals}, columns=OUTPUT_COLUMNS)


def user_step(threshold: int, keep_days: int | None):
    """The update of one user. All clicks of the batch that reaches the threshold
    still pass; later ones do not (JN3, AG4, FIL3, AG5).

    ``keep_days`` drops counts of days that far before the user's newest day;
    a later click on such a day starts from zero. None keeps every day."""

    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        listed, raw = state.get if state.exists else (False, "{}")
        made: dict = {}
        for b in batches:
            for day, ad, n in zip(b["date"].tolist(), b["ad_id"].tolist(), b["click_count"].tolist(), strict=True):
                made[day, ad] = made.get((day, ad), 0) + int(n)
        if not made:
            return
        if listed:
            yield _frame(key[0], [(NO_DAY, 0)], [BARRED], [0], [0])
            return
        counts = json.loads(raw)
        keys = sorted(made)
        totals = []
        for day, ad in keys:
            of_day = counts.setdefault(day.strftime("%Y%m%d"), {})
            of_day[str(ad)] = of_day.get(str(ad), 0) + made[day, ad]
            totals.append(of_day[str(ad)])
        kinds, clicks = [COUNT] * len(keys), [made[k] for k in keys]
        if max(totals) >= threshold:
            state.update((True, "{}"))             # a listed user's counts never change again
            yield _frame(key[0], [*keys, (NO_DAY, 0)], [*kinds, LISTED], [*clicks, 0], [*totals, 0])
            return
        yield _frame(key[0], keys, kinds, clicks, totals)
        if keep_days is not None:
            oldest = (pd.Timestamp(max(counts)) - pd.Timedelta(days=keep_days)).strftime("%Y%m%d")
            counts = {d: c for d, c in counts.items() if d > oldest}
        state.update((False, json.dumps(counts)))
    return step
