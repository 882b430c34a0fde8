"""Futures of a local run: five states, a result or an exception."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

PENDING, RUNNING, FINISHED, CANCELLED = "PENDING", "RUNNING", "FINISHED", "CANCELLED"


class Blocked(Exception):
    """A result is read that isn't there yet."""


class AggregateException(Exception):
    """Exceptions of several members, in their order; None where a member has none."""

    def __init__(self, exceptions: list):
        super().__init__("; ".join(f"{type(x).__name__}: {x}" for x in exceptions if x is not None))
        self.exceptions = exceptions

    def flatten(self) -> AggregateException:
        out: list = []
        for x in self.exceptions:
            if isinstance(x, AggregateException):
                out += x.flatten().exceptions
            elif x is not None:
                out.append(x)
        return AggregateException(out)

    def handle(self, handled) -> None:
        """Raise what ``handled`` (exception -> bool) doesn't take; nothing is raised if it takes all."""
        if rest := [x for x in self.flatten().exceptions if not handled(x)]:
            raise AggregateException(rest)


@dataclass
class Future:
    state: str = PENDING
    value: Any = None
    exception: BaseException | None = None

    @property
    def done(self) -> bool:
        return self.state in (FINISHED, CANCELLED)

    @property
    def result(self):
        if not self.done:
            raise Blocked(self.state)
        if self.exception is not None:
            raise self.exception
        return self.value

    def cancel(self) -> bool:
        """Whether it is cancelled now; a finished future can't be."""
        if self.state == FINISHED:
            return False
        self.state = CANCELLED
        return True

    def finish(self, value=None, exception=None) -> Future:
        self.state, self.value, self.exception = FINISHED, value, exception
        return self


def wait(*futures: Future) -> list:
    """Results in order; blocked while any is pending."""
    if any(f.state == PENDING for f in futures):
        raise Blocked(PENDING)
    return [f.result for f in futures]
