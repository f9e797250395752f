"""One atomic pointer per data set.

The state of a data set is a small numbered file that names its folders. Data goes to a new folder
first; the state that names it then appears at once, under the next number, or not at all: a
failure in between leaves the former state. Readers take the newest number. What it names stays in
place while later states are published, until ``kept`` newer ones have followed, so that a reader
finishes on what it began with. Of two writers at the same time the second one starts again from
the state of the first.

The store has to rename without overwriting in one step, as HDFS and local file systems do.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import SparkSession

from stratiscore.sources.files import delete, names_in, read_text, write_once

# Hidden from readers of the folder itself.
_STATES = "_states"
_DATA = "_data"
KEPT = 3


class Pointer:
    """State of the data set in one folder: entries by key, each with its facts.

    An entry whose facts have a ``folder`` owns that folder.
    """

    def __init__(self, spark: SparkSession, root: str, kept: int = KEPT):
        self.spark = spark
        self.root = root.rstrip("/")
        self.kept = kept

    def _state_path(self, number: int) -> str:
        return f"{self.root}/{_STATES}/{number:012d}.json"

    def _numbers(self) -> list[int]:
        names = names_in(self.spark, f"{self.root}/{_STATES}")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."]

    def _state(self, number: int) -> dict[str, dict] | None:
        """A state, or None where a writer has dropped it meanwhile."""
        text = read_text(self.spark, self._state_path(number))
        return None if text is None else json.loads(text)

    def _newest(self) -> tuple[int, dict[str, dict] | None]:
        while True:
            numbers = self._numbers()
            if not numbers:
                return 0, None
            state = self._state(numbers[-1])
            if state is not None:
                return numbers[-1], state

    def entries(self) -> dict[str, dict] | None:
        """The newest state, or None where none was published."""
        return self._newest()[1]

    def new_folder(self) -> str:
        """A place for data that no state names yet."""
        return f"{_DATA}/{uuid4().hex}"

    def path(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def publish(self, change: Callable[[dict[str, dict]], dict[str, dict]]) -> None:
        """Replace the state by what ``change`` makes of the newest one."""
        while True:
            last, state = self._newest()
            changed = json.dumps(change(state or {}))
            if write_once(self.spark, self._state_path(last + 1), changed):
                break
        self._clean()

    def _clean(self) -> None:
        """Drop the states that ``kept`` newer ones have followed, and folders only they name."""
        numbers = self._numbers()
        old, newer = numbers[: -self.kept], numbers[-self.kept :]
        if not old:
            return
        unused = {f for n in old for f in _folders(self._state(n) or {})}
        if unused:
            unused -= {f for n in newer for f in _folders(self._state(n) or {})}
        for folder in unused:
            delete(self.spark, self.path(folder))
        for number in old:
            delete(self.spark, self._state_path(number))

    def drop_folders(self, folders: set[str]) -> None:
        """Delete data at once that the newest state no longer names."""
        for folder in folders - _folders(self.entries() or {}):
            delete(self.spark, self.path(folder))


def _folders(state: dict[str, dict]) -> set[str]:
    return {facts["folder"] for facts in state.values() if "folder" in facts}
