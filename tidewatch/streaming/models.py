"""Publication of trained models: versioned folders and a pointer that moves in one step.

``publish`` saves a model in a folder of its own and then adds a pointer: a small file ``current/<number>`` that holds
the version, written under another name and renamed. The highest number is the current one. No file is ever written
over, so a reader finds either the old version or the new one, whole, and two publishers get two numbers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ..operators.ml import Trained
from ..session import hadoop_path


class ModelStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._loaded: tuple[str, Trained] | None = None

    def publish(self, trained: Trained) -> str:
        """Save the model and make it the current one; returns its version."""
        version = f"v-{uuid.uuid4().hex}"
        trained.save(f"{self.root}/versions/{version}")
        fs, folder = hadoop_path(self.spark, f"{self.root}/current")
        fs.mkdirs(folder)
        draft = hadoop_path(self.spark, f"{self.root}/current/.{version}")[1]
        out = fs.create(draft, False)
        out.write(bytearray(version.encode()))
        out.close()
        number = max(self._pointers(), default=0) + 1
        while not fs.rename(draft, hadoop_path(self.spark, f"{self.root}/current/{number:012d}")[1]):
            if number not in self._pointers():
                raise OSError(f"cannot move the pointer below {self.root}/current")
            number += 1  # another publisher took it
        return version

    def _pointers(self) -> list[int]:
        fs, folder = hadoop_path(self.spark, f"{self.root}/current")
        if not fs.exists(folder):
            return []
        return sorted(int(x.getPath().getName()) for x in fs.listStatus(folder) if x.getPath().getName().isdigit())

    def version(self, number: int | None = None) -> str:
        """The current version, or that of a pointer."""
        number = number if number is not None else max(self._pointers(), default=None)
        if number is None:
            raise FileNotFoundError(f"no model below {self.root} yet")
        return self.spark.read.text(f"{self.root}/current/{number:012d}").first()[0]

    def current(self) -> tuple[str, Trained]:
        """The current version and its model, read again only when the pointer has moved."""
        version = self.version()
        if self._loaded is None or self._loaded[0] != version:
            self._loaded = (version, Trained.load(f"{self.root}/versions/{version}"))
        return self._loaded

    def prune(self, keep: int = 3) -> list[str]:
        """Delete all but the last ``keep`` versions, pointers first; returns those deleted. Keep as many as readers
        may still be loading."""
        gone = []
        for number in self._pointers()[:-keep]:
            version = self.version(number)
            for path in (f"{self.root}/current/{number:012d}", f"{self.root}/versions/{version}"):
                fs, at = hadoop_path(self.spark, path)
                fs.delete(at, True)
            gone.append(version)
        return gone
