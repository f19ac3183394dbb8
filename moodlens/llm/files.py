"""Binary files written by tasks to a shared folder, committed through temporary names and a manifest.

A task writes to names of its own below ``_temporary`` and returns one manifest row per file. Only rows of tasks
that ended well reach the stored manifest; a second, repeatable pass gives those files their final names. What a
lost or repeated attempt left stays under temporary names that no manifest holds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame

from moodlens.llm.common import stored

#: Columns of a manifest that :func:`commit` needs.
MANIFEST = "part int, number int, temporary string, name string, bytes bigint"


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def temporary_name() -> str:
    return f"_temporary/{uuid.uuid4().hex}"


def create(folder: str, name: str) -> BinaryIO:
    system, path = locate(f"{folder}/{name}")
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path)


def open_input(folder: str, name: str) -> BinaryIO:
    system, path = locate(f"{folder}/{name}")
    return system.open_input_file(path)


def commit(manifest: DataFrame, folder: str) -> DataFrame:
    """Rename the files of ``manifest`` to their final names; returns the stored manifest."""
    rows = stored(manifest, "manifest")

    def rename(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for old, new in zip(part["temporary"], part["name"], strict=True):
                system, source = locate(f"{folder}/{old}")
                target = locate(f"{folder}/{new}")[1]
                # a repeated task finds the file moved already
                if system.get_file_info(source).type != fs.FileType.NotFound:
                    system.move(source, target)
                elif system.get_file_info(target).type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"neither {source} nor {target} exists")
            yield part

    return stored(rows.mapInPandas(rename, rows.schema), "manifest")
