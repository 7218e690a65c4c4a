"""Model arrays in the shared folder: weighted means among the tasks of one barrier stage, and arrays kept between jobs.

The tasks pass arrays through a folder that all of them reach, never through the driver: every task
writes its array, averages one slice of all of them, and reads the other slices. A task so moves three
times the model per round, however many tasks there are. The barrier starts the tasks together; within a
round they wait for each other's files, because every barrier message takes about a second. A file appears
under its name only when it is whole. If a task fails, Spark ends the others of its attempt. A round counts once its mark is written; a stage that is run again goes on after the last one.
Every attempt of a stage writes files of its own, and the last two rounds stay, because tasks of a failed
attempt may still finish the round they are in.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from windrow.scale import checkpoint_dir
from windrow.sources.books import opened


def room_for(spark: SparkSession, tasks: int) -> bool:
    """Whether ``tasks`` tasks surely run at the same time, as a barrier stage needs. With executors
    that come and go, or a number of cores that a setting hides, nothing is sure."""
    conf = spark.sparkContext.getConf()
    if conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true" or conf.get("spark.default.parallelism"):
        return False
    return spark.sparkContext.defaultParallelism // int(conf.get("spark.task.cpus", "1")) >= tasks


def new_folder(spark: SparkSession, name: str) -> str | None:
    """A new folder below the shared one, or None if Arrow's file systems cannot open its address."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    try:
        files, path = opened(folder)
        files.create_dir(path)
    except (pa.ArrowInvalid, OSError):
        return None
    return folder


def drop_folder(folder: str) -> None:
    files, path = opened(folder)
    files.delete_dir(path)


class Shelf:
    """Arrays that tasks put away and others take, between the jobs of a fit.

    They lie in a folder that all tasks reach; the driver only handles their names. Without a folder the
    array itself stands for its name and goes through the driver. Nothing is written twice under a name, so a task that
    runs again does not touch what another one reads.
    """

    def __init__(self, folder: str | None, dtype=np.float64):
        self.folder, self.dtype = folder, dtype

    @classmethod
    def new(cls, spark: SparkSession, name: str, dtype=np.float64) -> Shelf:
        return cls(new_folder(spark, name), dtype)

    def put(self, array: np.ndarray) -> bytes:
        data = np.ascontiguousarray(array, dtype=self.dtype).tobytes()
        if self.folder is None:
            return data
        files, root = opened(self.folder)
        name = uuid.uuid4().hex
        with files.open_output_stream(f"{root}/{name}") as out:
            out.write(data)
        return name.encode()

    def take(self, names: list[bytes]) -> list[np.ndarray]:
        if self.folder is None:
            return [np.frombuffer(n, self.dtype) for n in names]
        files, root = opened(self.folder)
        found = []
        for n in names:
            with files.open_input_file(f"{root}/{n.decode()}") as f:
                found.append(np.frombuffer(f.read(), self.dtype))
        return found

    def drop(self, names: list[bytes]) -> None:
        """Let arrays go that no task reads any more."""
        if self.folder is not None:
            files, root = opened(self.folder)
            for n in names:
                files.delete_file(f"{root}/{n.decode()}")

    def close(self) -> None:
        if self.folder is not None:
            drop_folder(self.folder)


class Exchange:
    """One task's side of the exchange; ``context`` is its barrier context."""

    def __init__(self, folder: str, context):
        self.files, self.root = opened(folder)
        self.context, self.part, self.parts = context, context.partitionId(), len(context.getTaskInfos())
        # All tasks of an attempt take the first one's name for it.
        self.attempt, self.made = context.allGather(uuid.uuid4().hex)[0], []

    def _put(self, path: str, data: bytes) -> None:
        with self.files.open_output_stream(f"{path}.part") as out:
            out.write(data)
        self.files.move(f"{path}.part", path)

    def _wait(self, paths: list[str]) -> list[str]:
        from pyarrow import fs

        left, pause = paths, 0.002
        while left := [f.path for f in self.files.get_file_info(left) if f.type != fs.FileType.File]:
            time.sleep(pause)
            pause = min(0.25, pause * 1.2)
        return paths

    def _told(self, path: str) -> list[float]:
        with self.files.open_input_file(path) as f:
            return json.loads(f.read())

    def _array(self, path: str, first: int = 0, count: int | None = None) -> np.ndarray:
        with self.files.open_input_file(path) as f:
            size = f.size() // 4 - first if count is None else count
            return np.frombuffer(f.read_at(4 * size, 4 * first), np.float32)

    def resume(self) -> tuple[int, dict, np.ndarray | None]:
        """The last finished round, its facts and array; 0, no facts and no array before the first one."""
        found = ""
        if self.part == 0:
            from pyarrow import fs

            marks = [f.base_name for f in self.files.get_file_info(fs.FileSelector(self.root)) if f.base_name.startswith("done-") and not f.base_name.endswith(".part")]
            if marks:
                with self.files.open_input_file(f"{self.root}/{max(marks)}") as f:
                    found = f.read().decode()
        found = self.context.allGather(found)[0]
        if not found:
            return 0, {}, None
        facts = json.loads(found)
        return facts["round"], facts, self._means(f"{self.root}/{facts['folder']}")

    def _means(self, folder: str) -> np.ndarray:
        return np.concatenate([self._array(f"{folder}/mean-{i}") for i in range(self.parts)])

    def _name(self, number: int) -> str:
        return f"{number:06d}-{self.attempt}"

    def mean(self, number: int, flat: np.ndarray, weight: float, facts: list[float]) -> tuple[np.ndarray, list[list[float]]]:
        """The mean of the tasks' arrays, by weight and in the order of the tasks, and all tasks' facts."""
        folder, size = f"{self.root}/{self._name(number)}", len(flat)
        self.files.create_dir(folder)
        if weight:
            self._put(f"{folder}/part-{self.part}", (flat * np.float32(weight)).tobytes())
        self._put(f"{folder}/facts-{self.part}", json.dumps([weight, *facts]).encode())
        told = [self._told(p) for p in self._wait([f"{folder}/facts-{i}" for i in range(self.parts)])]
        total = sum(t[0] for t in told)
        first, after = size * self.part // self.parts, size * (self.part + 1) // self.parts
        if total:
            mine = np.zeros(after - first, np.float32)
            for i, (other, *_) in enumerate(told):
                if other:
                    mine += self._array(f"{folder}/part-{i}", first, after - first)
            mine /= np.float32(total)
        else:
            mine = flat[first:after]
        self._put(f"{folder}/mean-{self.part}", mine.astype(np.float32).tobytes())
        self._wait([f"{folder}/mean-{i}" for i in range(self.parts)])
        return self._means(folder), told

    def finish(self, number: int, facts: dict) -> None:
        """Mark the round as done and let this attempt's last but one go."""
        if self.part:
            return
        name = self._name(number)
        self._put(f"{self.root}/done-{name}", json.dumps({"round": number, "folder": name, **facts}).encode())
        self.made.append(name)
        if len(self.made) > 2:
            old = self.made.pop(0)
            self.files.delete_file(f"{self.root}/done-{old}")
            self.files.delete_dir(f"{self.root}/{old}")


class Held:
    """A task's batches in a file of its own in the shared folder, to be read once per round."""

    def __init__(self, exchange: Exchange, batches: Iterator[pa.RecordBatch]):
        self.files, self.path = exchange.files, f"{exchange.root}/rows-{exchange.part}-{exchange.attempt}"
        self.empty, writer = True, None
        with self.files.open_output_stream(self.path) as out:
            for b in batches:
                if writer is None:
                    writer, self.empty = pa.ipc.new_file(out, b.schema), False
                writer.write_batch(b)
            if writer is not None:
                writer.close()

    def __iter__(self) -> Iterator[pa.RecordBatch]:
        if self.empty:
            return
        with self.files.open_input_file(self.path) as f:
            reader = pa.ipc.open_file(f)
            for i in range(reader.num_record_batches):
                yield reader.get_batch(i)
