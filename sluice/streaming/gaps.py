"""What the tasks of a page stream leave for its driver: pages asked for that held nothing.

A folder that driver and tasks share, through pyarrow's file systems. `planned` holds the offset
planned last; `gaps/ENDPOINT/ROUND/FIRST-LAST` the intervals of one task, replaced whole when
the task runs again.
"""

from __future__ import annotations

import json
from urllib.parse import quote

from sluice.sources import intervals as I
from sluice.sources.fetch import open_file_system
from sluice.sources.planner import PageRange


class GapLog:
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def planned(self) -> dict | None:
        text = self._read(f"{self.path}/planned")
        return None if text is None else json.loads(text)

    def plan(self, offset: dict) -> None:
        self._write("", "planned", json.dumps(offset))

    def note(self, task: PageRange, gaps: I.Intervals) -> None:
        self._write(self._folder(task.endpoint, task.round), f"{task.start_page}-{task.end_page}", I.to_text(gaps))

    def gaps(self, endpoint: str, round_: int) -> I.Intervals:
        """All gaps that the tasks of a round have noted."""
        from pyarrow import fs

        files, folder = open_file_system(f"{self.path}/{self._folder(endpoint, round_)}")
        found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        texts = (files.open_input_stream(f.path).read().decode() for f in found if f.is_file and not f.base_name.startswith("."))
        return I.normal(p for text in texts for p in I.from_text(text))

    @staticmethod
    def _folder(endpoint: str, round_: int) -> str:
        # No name is empty, or leads out of the folder.
        return f"gaps/@{quote(endpoint, safe='')}/{round_}"

    def _read(self, location: str) -> str | None:
        from pyarrow import fs

        files, path = open_file_system(location)
        if files.get_file_info(path).type == fs.FileType.NotFound:
            return None
        return files.open_input_stream(path).read().decode()

    def _write(self, folder: str, name: str, text: str) -> None:
        """Written beside and moved, so that no reader finds half a file."""
        files, at = open_file_system(f"{self.path}/{folder}".rstrip("/"))
        files.create_dir(at, recursive=True)
        with files.open_output_stream(f"{at}/.{name}.new") as out:
            out.write(text.encode())
        files.move(f"{at}/.{name}.new", f"{at}/{name}")
