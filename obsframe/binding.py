"""How an operator finds the series inside a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Binding:
    """Column roles of an observation frame.

    ``key`` names the series, ``ts`` orders it, ``id`` breaks ties on ``ts`` so
    that the order is total, ``values`` are the measured columns.
    """

    key: tuple[str, ...]
    ts: str
    values: tuple[str, ...]
    id: tuple[str, ...] = ()

    @property
    def value(self) -> str:
        return self.values[0]

    @property
    def order(self) -> tuple[str, ...]:
        return (self.ts, *self.id)

    def on(self, *values: str) -> Binding:
        return replace(self, values=values)
