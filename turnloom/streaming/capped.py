"""Capped clip groups over a stream (an extension: the batch engine has no streaming counterpart).

``session_window`` has no cap on rows, so groups are kept as state per channel and date and handed out when a clip
lies beyond the gap, the cap is reached, or the watermark passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "channel_name string, start timestamp, end timestamp, n_clips int, plain_text string"


def stream_groups(clips: DataFrame, gap_s: int = 60, cap: int = 5, late: str = "10 minutes") -> DataFrame:
    """Groups of ``channel_name, at, plain_text``; clips later than ``late`` are dropped by the watermark."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        rows = [tuple(x.split("\x1f", 1)) for x in held]
        done = []

        def flush() -> None:
            if rows:
                done.append((key[0], pd.Timestamp(int(rows[0][0]), unit="us"), pd.Timestamp(int(rows[-1][0]), unit="us"), len(rows), " ".join(t for _, t in rows if t)))
                rows.clear()

        if state.hasTimedOut:
            flush()
            state.remove()
        else:
            got = pd.concat(list(batches)).sort_values("at", kind="stable")
            for at, text in zip(got["at"], got["plain_text"]):
                us = int(at.value // 1000) if at.unit == "ns" else int(at.as_unit("us").value)
                if rows and (us - int(rows[-1][0]) > gap_s * 1_000_000 or len(rows) >= cap):
                    flush()
                rows.append((str(us), text or ""))
            state.update(([f"{a}\x1f{t}" for a, t in rows],))
            last = int(rows[-1][0]) // 1000 + gap_s * 1000
            state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(done, columns=["channel_name", "start", "end", "n_clips", "plain_text"])

    return clips.withWatermark("at", late).groupBy("channel_name").applyInPandasWithState(step, OUT, "rows array<string>", "append", GroupStateTimeout.EventTimeTimeout)
