"""Which load may change a replica: a file that only one of them can create."""

from __future__ import annotations

import json
import uuid

from epochfold.sources.files import Files


class BusyError(RuntimeError):
    """Another load owns the replica."""


class FencedError(RuntimeError):
    """Another load has taken the replica over from this one."""


class Owner:
    """Ownership of a replica by one load at a time.

    The file names the load that owns the replica. Who comes later is refused, unless it repeats the
    same run (its first attempt is then taken for dead) or takes over on purpose. A load looks at the
    file before each of its steps and stops once the file names another.
    """

    def __init__(self, files: Files, path: str):
        self.files, self.path = files, path
        self.token: str | None = None

    def _current(self) -> dict | None:
        try:
            return json.loads(self.files.read_text(self.path) or "{}")
        except FileNotFoundError:
            return None

    def take(self, run_id: str, over: bool = False) -> None:
        """Become the owner. ``over`` takes the place of any other."""
        self.token = None
        token = uuid.uuid4().hex
        text = json.dumps({"token": token, "run_id": run_id})
        if not self.files.create(self.path, text):
            current = self._current() or {}
            if not over and current.get("run_id") != run_id:
                raise BusyError(
                    f"load {current.get('run_id')!r} owns {self.path}; if it is dead, call recover()"
                )
            self.files.write_text(self.path, text)
        self.token = token
        self.check()

    def check(self) -> None:
        """Stop if another load has become the owner."""
        current = self._current()
        if self.token is None or current is None or current.get("token") != self.token:
            raise FencedError(f"{self.path} names another load")

    def drop(self) -> None:
        """Let others in, if this load is the owner still."""
        current = self._current()
        if current is not None and current.get("token") == self.token:
            self.files.delete(self.path)
        self.token = None
