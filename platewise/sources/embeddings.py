"""Deep-learning embeddings in NPZ archives."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator, Mapping
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.columns import quoted


def read_npz(
    spark: SparkSession,
    path: str,
    features_key: str = "features",
    metadata_key: str | None = "metadata",
    path_pattern: str | None = None,
    locations_key: str | None = None,
) -> DataFrame:
    """One row per cell: the file, its metadata as a map and the embedding vector.

    The array names are those of the writer; a file may hold one vector or a
    matrix of one row per cell. Arrays of objects, such as a dictionary of metadata,
    would have to be unpickled, so they are passed over; ``path_pattern``, a regular
    expression with named groups, takes metadata from the file's path instead. With
    ``locations_key`` that array's rows come along as ``location``, null where a file
    has none.
    """
    files = (
        spark.read.format("binaryFile")
        .options(pathGlobFilter="*.npz", recursiveFileLookup="true")
        .load(path)
        .select("path", "content")
    )

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                with np.load(io.BytesIO(content), allow_pickle=False) as archive:
                    plain = {key: archive[key] for key in _plain_arrays(archive)}
                if features_key not in plain:
                    raise ValueError(f"{name} has no plain array {features_key}")
                matrix = np.atleast_2d(plain[features_key]).astype(np.float32)
                about = _metadata(plain, metadata_key)
                if path_pattern and (found := re.search(path_pattern, unquote(name))):
                    about |= {k: v for k, v in found.groupdict().items() if v is not None}
                cells = {
                    "path": name,
                    "cell": np.arange(len(matrix), dtype=np.int64),
                    "metadata": [about] * len(matrix),
                    "embedding": list(matrix),
                }
                if locations_key:
                    where = plain.get(locations_key)
                    given = where is not None and len(where) == len(matrix)
                    cells["location"] = (
                        list(np.asarray(where, dtype=np.float64)) if given else [None] * len(matrix)
                    )
                yield pd.DataFrame(cells)

    schema = "path string, cell bigint, metadata map<string,string>, embedding array<float>"
    if locations_key:
        schema += ", location array<double>"
    return files.mapInPandas(load, schema)


def _plain_arrays(archive: np.lib.npyio.NpzFile) -> list[str]:
    """Names of the arrays that hold no objects, by what their headers say."""
    found = []
    for key in archive.files:
        with archive.zip.open(f"{key}.npy") as opened:
            version = np.lib.format.read_magic(opened)
            read = np.lib.format.read_array_header_1_0
            if version >= (2, 0):
                read = np.lib.format.read_array_header_2_0
            _, _, dtype = read(opened)
        if not dtype.hasobject:
            found.append(key)
    return found


def _metadata(plain: Mapping[str, np.ndarray], key: str | None) -> dict[str, str]:
    """Metadata stored as two-column text, else every scalar of the archive."""
    pairs = plain.get(key) if key else None
    if pairs is not None and pairs.ndim == 2 and pairs.shape[1] == 2:
        return {str(k): str(v) for k, v in pairs}
    return {name: str(value) for name, value in plain.items() if value.ndim == 0}


def spread_embedding(
    df: DataFrame, width: int, prefix: str, metadata: Mapping[str, str] | None = None
) -> DataFrame:
    """Embedding vector to columns ``<prefix>_1..n`` behind the named metadata entries."""
    kept = [c for c in df.columns if c not in ("embedding", "metadata")]
    about = [f"metadata['{key}'] AS {quoted(name)}" for key, name in (metadata or {}).items()]
    values = [f"embedding[{i}] AS {quoted(f'{prefix}_{i + 1}')}" for i in range(width)]
    return df.selectExpr(*about, *map(quoted, kept), *values)


def embedding_width(df: DataFrame) -> int:
    """Length of the embeddings, which must be the same everywhere."""
    low, high = df.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if low is None:
        raise FileNotFoundError("no embeddings")
    if low != high:
        raise ValueError(f"embeddings have between {low} and {high} values")
    return low
