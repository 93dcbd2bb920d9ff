"""What counts of one or several sinks, as one small record that is replaced as a whole.

Each sink has a section.  Sinks that share a record move together: a reader sees a batch in all of them or in none.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from unirec.functions.shared import read_state, write_state


class Commits:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def all(self) -> dict:
        text = read_state(self.spark, self.folder)
        return json.loads(text) if text else {}

    def get(self, section: str) -> dict | None:
        return self.all().get(section)

    def put(self, sections: dict[str, dict]) -> None:
        """Replace the named sections, all at once; the others stay."""
        write_state(self.spark, self.folder, json.dumps(self.all() | sections, separators=(",", ":")))
