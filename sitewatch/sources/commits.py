"""Rows that say what of a table counts, each in a file of its own that is created once.

A file appears as a whole and under its own number or not at all, by a rename that does not
replace: as atomic as the file system makes that. Of two writers one is told that it came second.
"""

import json
import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# A local file system's rename is a check and a move; writers of one driver take turns.
_turn = threading.Lock()


def create_row(spark: SparkSession, folder: str, number: int, row: dict) -> bool:
    """Create row ``number`` of ``folder``; False, and nothing is written, if there is one."""
    fs = spark._jvm.org.apache.hadoop.fs
    final = fs.Path(f"{folder}/{number:012d}.json")
    hidden = fs.Path(f"{folder}/.{uuid.uuid4().hex}")
    conf = spark._jsc.hadoopConfiguration()
    out = hidden.getFileSystem(conf).create(hidden)
    out.write(bytearray(json.dumps(row).encode()))
    out.close()
    files = fs.FileContext.getFileContext(final.toUri(), conf)
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        with _turn:
            files.rename(hidden, final, options)
    except Py4JJavaError as error:
        hidden.getFileSystem(conf).delete(hidden, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True
