"""Plans of sequential ministacks: which epochs a stage solves and which compressed inputs it carries."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Stage:
    number: int
    start: int
    stop: int
    compressed: tuple[str, ...]
    output: str | None

    @property
    def real(self) -> int:
        return self.stop - self.start

    @property
    def solver_size(self) -> int:
        return self.real + len(self.compressed)


def sequential_plan(epochs: int, ministack: int, most_history: int | None = None, reference: int = 0) -> list[Stage]:
    """Stages of at most ``ministack`` real epochs; each carries one compressed input of every stage before it, the latest ``most_history`` of them.

    A ministack that holds all epochs makes a single stage without compressed inputs or output. The
    first epoch is the reference of a sequence.
    """
    if epochs < 2 or ministack < 2:
        raise ValueError("a plan needs two epochs and two epochs a stage at least")
    if ministack >= epochs:
        return [Stage(0, 0, epochs, (), None)]
    if reference:
        raise ValueError("the reference of a sequential plan is epoch 0")
    out = []
    for k, start in enumerate(range(0, epochs, ministack)):
        history = [f"c{i:04d}" for i in range(k)]
        if most_history is not None:
            history = history[max(0, k - most_history) :]
        out.append(Stage(k, start, min(epochs, start + ministack), tuple(history), f"c{k:04d}"))
    return out
