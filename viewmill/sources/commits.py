"""Which loads of a star readers may see."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    """File system calls below one root, whatever file system it is on."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root
        self._jvm, self._hadoop = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self._hadoop)

    def escaped(self, value: str) -> str:
        """``value`` as Spark spells it in the name of a partition folder."""
        return self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)

    def unescaped(self, name: str) -> str:
        return self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name)

    def matching(self, pattern: str) -> list[str]:
        target, files = self._at(pattern)
        return [str(found.getPath()) for found in files.globStatus(target) or []]

    def exists(self, path: str) -> bool:
        target, files = self._at(path)
        return files.exists(target)

    def make(self, path: str) -> None:
        target, files = self._at(path)
        files.mkdirs(target)

    def delete(self, path: str) -> None:
        target, files = self._at(path)
        files.delete(target, True)

    def write(self, path: str, text: str = "") -> None:
        target, files = self._at(path)
        out = files.create(target, True)
        out.write(bytearray(text.encode()))
        out.close()

    def text(self, path: str) -> str:
        target, files = self._at(path)
        source = files.open(target)
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def rename(self, path: str, to: str) -> None:
        target, files = self._at(path)
        if not files.rename(target, self._at(to)[0]):
            raise OSError(f"{path} could not be renamed")

    def names(self, folder: str) -> dict[str, int]:
        """The files of a folder with their times, none if it does not exist."""
        target, files = self._at(folder)
        if not files.exists(target):
            return {}
        return {str(f.getPath().getName()): f.getModificationTime() for f in files.listStatus(target)}


# No marker of a load begins like these, as "=" is escaped there: what is written whenever a load ends, and what the
# marker of a load that replaced others is called from then on.
_ENDED, _REPLACED = "=ended", "=replaced-"


class OpenLoads:
    """Markers of loads that have begun and not ended: a load's rows count only while it has none.

    A load spans several tables that are written one after the other. Its marker is there before its first row and goes
    after its last, in one file operation, which is what commits it. A load that failed keeps its marker; readers skip
    its rows and the next attempt clears them. Usually there is no marker or one, so readers need no list of loads.
    """

    def __init__(self, folders: Folders):
        self.folders = folders
        self.path = f"{folders.root}/_open_loads"

    def _marker(self, load_id: str) -> str:
        return f"{self.path}/{self.folders.escaped(load_id)}"

    def begin(self, load_id: str, replaces: list[str] | None = None) -> None:
        self.folders.write(self._marker(load_id), "\n".join(self.folders.escaped(r) for r in replaces or []))

    def commit(self, load_id: str) -> None:
        """End a load. Its marker goes; that of one that replaces others turns into the list of those, in one rename."""
        # Tells readers that were listing files meanwhile, even if they saw neither begin nor end.
        self.folders.write(f"{self.path}/{_ENDED}")
        marker = self._marker(load_id)
        if self.folders.text(marker):
            self.folders.rename(marker, f"{self.path}/{_REPLACED}{self.folders.escaped(load_id)}")
        else:
            self.folders.delete(marker)

    def state(self) -> dict[str, int]:
        """Markers with their times; two equal states mean that no load began or ended between them."""
        return self.folders.names(self.path)

    def open_in(self, state: dict[str, int]) -> list[str]:
        """The loads that were open in a state."""
        return sorted(self.folders.unescaped(name) for name in state if not name.startswith((".", "=")))

    def hidden_in(self, state: dict[str, int]) -> list[str]:
        """The loads whose rows did not count in a state: open ones, and those that another has replaced."""
        replaced = [r for listed in self.replaced(state).values() for r in listed]
        return sorted({*self.open_in(state), *replaced})

    def replaced(self, state: dict[str, int] | None = None) -> dict[str, list[str]]:
        """Markers of loads that replaced others, with those others."""
        markers = [name for name in (self.state() if state is None else state) if name.startswith(_REPLACED)]
        texts = {marker: self.folders.text(f"{self.path}/{marker}") for marker in markers}
        return {marker: [self.folders.unescaped(r) for r in text.split("\n")] for marker, text in texts.items()}

    def forget(self, marker: str) -> None:
        """Remove the marker of a load that replaced others, when nothing of those is left."""
        self.folders.write(f"{self.path}/{_ENDED}")
        self.folders.delete(f"{self.path}/{marker}")
