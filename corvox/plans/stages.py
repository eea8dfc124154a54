"""Ordered stages over one corpus."""

from __future__ import annotations

from collections.abc import Callable

STAGES = ("ingest", "generate", "split", "augment", "features", "train", "evaluate")


def run(jobs: dict[str, Callable[[], bool]], skip: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """Runs the given jobs in the fixed order: (stage, "done", "skipped" or "failed"). A job returns whether the next may
    run; the first that doesn't, or raises, is the last. Unknown names are an error before any runs."""
    unknown = (set(jobs) | set(skip)) - set(STAGES)
    if unknown:
        raise KeyError(f"no such stages: {', '.join(sorted(unknown))}")
    out = []
    for stage in (s for s in STAGES if s in jobs):
        if stage in skip:
            out.append((stage, "skipped"))
            continue
        try:
            done = jobs[stage]()
        except Exception as e:  # noqa: BLE001  reported as the stage's status
            out.append((stage, f"failed: {e}"))
            break
        out.append((stage, "done" if done else "failed"))
        if not done:
            break
    return out
