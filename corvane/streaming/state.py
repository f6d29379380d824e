"""Stateful streams: conversation memory under a byte budget."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "memory_id bigint, kept bigint, kept_bytes bigint, forgotten bigint, oldest string"
STATE = "times array<timestamp>, ids array<string>, sizes array<bigint>, forgotten bigint"


def memory_state(messages: DataFrame, capacity: int) -> DataFrame:
    """Retained messages of each memory as messages arrive: the oldest are forgotten while the bytes pass ``capacity``.

    Input ``memory_id, message_id, valid_at, size``. The state of a memory holds no more than its budget of messages,
    and a trigger's rows pass through a heap of that budget, so a busy memory does not grow in the task. What is kept
    is the longest newest run within the capacity, in whatever order and pieces the rows of a trigger come.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, forgotten = [], 0
        if state.exists:
            times, ids, sizes, forgotten = state.get
            held = list(zip(times, ids, sizes))
        heapq.heapify(held)
        total, gone = sum(m[2] for m in held), None
        for batch in batches:
            for message in zip(batch["valid_at"], batch["message_id"], batch["size"]):
                # what is older than a forgotten message would have been forgotten before it
                if gone is not None and message < gone:
                    forgotten += 1
                    continue
                heapq.heappush(held, message)
                total += message[2]
                while total > capacity:
                    gone = heapq.heappop(held)
                    total -= gone[2]
                    forgotten += 1
        held.sort()
        state.update(([m[0] for m in held], [m[1] for m in held], [int(m[2]) for m in held], int(forgotten)))
        yield pd.DataFrame(
            {
                "memory_id": [key[0]],
                "kept": [len(held)],
                "kept_bytes": [int(sum(m[2] for m in held))],
                "forgotten": [int(forgotten)],
                "oldest": [held[0][1] if held else None],
            }
        )

    return messages.groupBy("memory_id").applyInPandasWithState(update, OUTPUT, STATE, "update", GroupStateTimeout.NoTimeout)
