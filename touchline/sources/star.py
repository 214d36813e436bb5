"""The star on disk: every load writes a whole new set of tables, then readers switch to it."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import schemas
from touchline.sources.scratch import Seen, delete, with_rows

_RUNS, _CURRENT = "runs", "current"


class StarWriter:
    """One load: tables go to a folder of their own and become visible together.

    A load that fails half-way leaves the tables of the one before it in place.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        self.run = uuid.uuid4().hex
        self.path = f"{self.out}/{_RUNS}/{self.run}"
        # Rows of each table written, and the NULLs in the columns that must be filled.
        self.rows: dict[str, int] = {}
        self.nulls: dict[str, dict[str, int]] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write one table in its fixed schema and return it as read back. Its rows and NULLs are counted
        by the tasks that write them, so no finished table is scanned for that."""
        schema, required = schemas.STAR[name], schemas.REQUIRED_COLUMNS.get(name, [])
        table = df.select(*[df[field.name].cast(field.dataType) for field in schema])
        seen = Seen(table, {column: F.count_if(F.col(column).isNull()) for column in required})
        seen.rows.write.parquet(f"{self.path}/{name}")
        values = seen.values()
        self.rows[name], self.nulls[name] = values["_rows"], {column: values[column] for column in required}
        return with_rows(self.spark.read.schema(schema).parquet(f"{self.path}/{name}"), self.rows[name])

    def publish(self, keep: int = 2) -> None:
        """Make this run the current one: it takes the next free turn, and the last turn counts.

        A turn is a file that only one load can create, so of two loads at once each gets its own.
        The last `keep` runs stay, for readers that still use them; older ones go with their turns.
        """
        folder = _Folder(self.spark, f"{self.out}/{_CURRENT}")
        turn = max(folder.names(), default=0) + 1
        while not folder.create(turn, self.run):
            turn += 1
        for old in sorted(name for name in folder.names() if name <= turn)[:-keep]:
            run = folder.read(old)
            if run:
                delete(self.spark, f"{self.out}/{_RUNS}/{run}")
            folder.remove(old)

    def discard(self) -> None:
        """Delete the tables of a run that will not be published."""
        delete(self.spark, self.path)


class _Folder:
    """The turns taken so far: small files named by number, each holding the run that took it."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.path = self.hadoop.Path(path)
        self.system = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, turn: int):
        return self.hadoop.Path(self.path, f"{turn:012d}")

    def names(self) -> list[int]:
        if not self.system.exists(self.path):
            return []
        names = [status.getPath().getName() for status in self.system.listStatus(self.path)]
        return [int(name) for name in names if name.isdigit()]

    def create(self, turn: int, run: str) -> bool:
        """Take a turn; False if another load was first."""
        if self.system.exists(self._at(turn)):
            return False
        try:
            out = self.system.create(self._at(turn), False)
        except Py4JJavaError:
            if self.system.exists(self._at(turn)):
                return False
            raise
        out.write(bytearray(run.encode()))
        out.close()
        return True

    def read(self, turn: int) -> str:
        """The run of a turn; empty while it is being written."""
        if not self.system.exists(self._at(turn)):
            return ""
        source = self.system.open(self._at(turn))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def remove(self, turn: int) -> None:
        self.system.delete(self._at(turn), False)


def read_star(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The nine tables of the last published load."""
    folder = _Folder(spark, f"{out.rstrip('/')}/{_CURRENT}")
    run = next((run for turn in sorted(folder.names(), reverse=True) if (run := folder.read(turn))), None)
    if run is None:
        raise FileNotFoundError(f"no star has been published in {out}")
    path = f"{out.rstrip('/')}/{_RUNS}/{run}"
    return {
        name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in schemas.STAR.items()
    }
