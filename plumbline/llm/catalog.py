"""The registered queries of this folder and the SQL of those that SQL can express."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable
from functools import wraps

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

import plumbline
from plumbline.llm.chat import OP4_SQL, op4_chat
from plumbline.llm.decontamination import op7_decontamination
from plumbline.llm.line_dedup import op3_line_dedup
from plumbline.llm.packing import op2_packing
from plumbline.llm.prefix_trie import op11_prefix_trie
from plumbline.llm.private_data import op12_pii
from plumbline.llm.quality_cotraining import op6_quality_cotraining
from plumbline.llm.quality_rules import op10_quality_rules
from plumbline.llm.secrets import op8_secrets
from plumbline.llm.simhash import op5_simhash
from plumbline.llm.spelling import op13_spelling
from plumbline.llm.toxicity import op9_toxicity
from plumbline.llm.warc import op1_warc
from plumbline.storage import run_folder

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the workers of a session, so that tasks find it wherever they run; once for an application."""
    if spark.sparkContext.applicationId in _shipped:
        return
    root = os.path.dirname(plumbline.__file__)
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    folder = run_folder(spark, "package")
    store, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/plumbline.zip", compression=None) as out:
        out.write(body.getvalue())
    spark.sparkContext.addPyFile(f"{folder}/plumbline.zip")
    _shipped.add(spark.sparkContext.applicationId)


def _with_package(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


QUERIES = {
    "op1_warc": op1_warc,
    "op2_packing": op2_packing,
    "op3_line_dedup": op3_line_dedup,
    "op4_chat": op4_chat,
    "op5_simhash": op5_simhash,
    "op6_quality_cotraining": op6_quality_cotraining,
    "op7_decontamination": op7_decontamination,
    "op8_secrets": op8_secrets,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_pii": op12_pii,
    "op13_spelling": op13_spelling,
}
QUERIES = {name: _with_package(query) for name, query in QUERIES.items()}
SQL: dict[str, str] = {
    "op4_chat": OP4_SQL,
}
