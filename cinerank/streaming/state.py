"""Recent-K ratings per user as keyed streaming state.

The original kept each user's latest ratings in an external list store that
some other process filled. `recent_ratings_state` keeps the same list inside
the stream: `applyInPandasWithState` keyed by uid, the state being the
user's K newest (mid, score, ts). Late records are placed by timestamp, not
by arrival. The output, per user touched by a micro-batch, is the user's
latest event of the batch and the updated list.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cinerank.session import ship_package

STATE_SCHEMA = "recents array<struct<mid:bigint,score:double,ts:bigint>>"
OUTPUT_SCHEMA = ("uid bigint, mid bigint, score double, ts bigint, "
                 "recents array<struct<mid:bigint,score:double,ts:bigint>>")


def _newest(rows: list, k: int) -> list:
    # newest first; equal timestamps by mid ascending, score descending
    return sorted(rows, key=lambda t: (-t[2], t[0], -t[1]))[:k]


def _update_fn(k: int):
    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        keep = [(int(r[0]), float(r[1]), int(r[2])) for r in state.get[0]] if state.exists else []
        last = None
        # a user's rows come in chunks; only K of them are held on to
        for new in pdfs:
            rows = list(zip(new["mid"].tolist(), new["score"].tolist(), new["ts"].tolist()))
            keep = _newest(keep + rows, k)
            top = max((t, m, s) for m, s, t in rows)
            last = top if last is None else max(last, top)
        state.update((keep,))
        ts, mid, score = last
        yield pd.DataFrame({
            "uid": [int(key[0])], "mid": [int(mid)], "score": [float(score)], "ts": [int(ts)],
            "recents": [[{"mid": m, "score": s, "ts": t} for m, s, t in keep]],
        })
    return fn


def recent_ratings_state(ratings_stream: DataFrame, k: int = 20) -> DataFrame:
    """Streaming (uid, mid, score, ts, recents) in update mode."""
    ship_package(ratings_stream.sparkSession)
    return ratings_stream.select("uid", "mid", "score", "ts").groupBy("uid").applyInPandasWithState(
        _update_fn(k), OUTPUT_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout)
