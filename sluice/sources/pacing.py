"""One request rate for all tasks of a barrier stage.

The tasks go in rounds. Before each they tell each other how many requests they have left and
agree on who takes which of the round's equally spaced times, in proportion to what is left. So the
rate is used in full until the last request, whatever the tasks hold, and a task that has
ended takes no part of it.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Iterator
from concurrent.futures import Future, ThreadPoolExecutor

ROUND_SECONDS = 5.0


def share_times(left: list[int], n: int, task: int) -> list[int]:
    """Which of the times 0 .. n-1 belong to a task, when each task has `left` requests.

    All tasks reach the same division: whole parts first, then the largest remainders, each
    task's times spread evenly over the round.
    """
    total = sum(left)
    n = min(n, total)
    parts = [n * x // total for x in left]
    rest = sorted(range(len(left)), key=lambda i: (-(n * left[i] % total), i))
    for i in rest[: n - sum(parts)]:
        parts[i] += 1
    order = sorted(((m + 0.5) / parts[i], i) for i in range(len(left)) for m in range(parts[i]))
    return [at for at, (_, i) in enumerate(order) if i == task]


def paced(work: deque, rate: float, capacity: float, context) -> Iterator:
    """Takes items off `work` when their time has come; the caller may add items meanwhile.

    `context` is the barrier context of the task. At most rate x seconds + `capacity` + 1 items are
    taken in any span of time by all tasks together: a time that is missed by more than
    the capacity is given up.

    What a task will have left after a round is known when the round begins, so the next round is
    agreed on meanwhile, in a thread; what is given up or added later waits for the round after.
    """
    late = max(capacity, 1.0) / rate
    began = time.monotonic()
    with ThreadPoolExecutor(1) as aside:

        def agreed(left: int) -> Future:
            return aside.submit(lambda: [int(x) for x in context.allGather(str(left))])

        left = agreed(len(work)).result()
        while sum(left):
            began = max(began, time.monotonic())
            n = min(sum(left), max(1, int(rate * ROUND_SECONDS)))
            own = share_times(left, n, context.partitionId())
            following = agreed(len(work) - len(own))
            for slot in own:
                due = began + slot / rate
                now = time.monotonic()
                if now > due + late:
                    continue
                if now < due:
                    time.sleep(due - now)
                yield work.popleft()
            began += n / rate
            left = following.result()
            if not sum(left):  # nothing was left by plan: what is there really?
                left = agreed(len(work)).result()
