"""Archives made as files lie in one folder, and their chunks are cut once."""

import glob
import os

from threadloom.operators.durable import shared_dir
from threadloom.plans import archive_queries
from threadloom.sources import splittable


def test_files_of_one_folder(spark):
    path = archive_queries._folder(spark, "/root/testdata/sf0.001").removeprefix("file://")
    names = [n for n in os.listdir(path) if not n.startswith(".")]
    assert len(names) > 1 and "broken_archive.json" in names and all(n.endswith("_archive.json") and os.path.isfile(f"{path}/{n}") for n in names)
    before = set(glob.glob(f"{shared_dir(spark).removeprefix('file://')}/threadloom/archive-pieces-*"))
    split = splittable.read(spark, path)
    assert split.archives.count() == len(names) and split.entries.count() > len(names)
    assert len(set(glob.glob(f"{shared_dir(spark).removeprefix('file://')}/threadloom/archive-pieces-*")) - before) == 1
