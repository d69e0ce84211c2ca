"""An object store for tests: whole objects by key, no folders, and a fault at a chosen step."""

import io
import os
import shutil

from pyarrow import fs as pafs

#: Steps (writes, moves, copies, deletions) left until one fails; None for no fault.
STEPS_LEFT = None


class Fault(OSError):
    pass


class _Object(io.BytesIO):
    def __init__(self, path):
        super().__init__()
        self.path = path

    def __exit__(self, kind, *rest):
        if kind is None:
            _step()
            os.makedirs(os.path.dirname(self.path), exist_ok=True)
            with open(self.path, "wb") as out:
                out.write(self.getvalue())


def _step():
    global STEPS_LEFT
    if STEPS_LEFT is not None:
        STEPS_LEFT -= 1
        if STEPS_LEFT < 0:
            raise Fault("the store went away")


class ObjectStore:
    """The part of a file system that an object store can offer; objects are kept as local files."""

    def __init__(self):
        self.local = pafs.LocalFileSystem()

    def get_file_info(self, what):
        return self.local.get_file_info(what)

    def create_dir(self, path, recursive=True):
        pass

    def open_output_stream(self, path):
        return _Object(path)

    def open_input_stream(self, path):
        return open(path, "rb")

    def copy_file(self, source, target):
        _step()
        os.makedirs(os.path.dirname(target), exist_ok=True)
        shutil.copyfile(source, target)

    def move(self, source, target):
        if os.path.isdir(source):
            raise IsADirectoryError("an object store cannot move a folder")
        self.copy_file(source, target)
        os.unlink(source)

    def delete_file(self, path):
        _step()
        os.unlink(path)

    def delete_dir(self, path):
        for folder, _, names in os.walk(path):
            for name in names:
                self.delete_file(os.path.join(folder, name))


def open_store(uri):
    return ObjectStore(), uri.removeprefix("objects://")
