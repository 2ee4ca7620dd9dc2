"""Rows of an embedding table as plain bytes, with what may take part marked."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_USABLE = "vec_id long, label string, vec binary, key binary"


def _encoded(batches):
    """Double-precision bytes and a key by label and components; null if unusable."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("vec", pa.binary()), ("key", pa.binary())])
    for batch in batches:
        labels = batch.column("label").to_pylist()
        vecs, keys = [], []
        for label, vec_id, item in zip(labels, batch.column("vec_id"), batch.column("embedding")):
            vec = key = None
            values = item.values
            if item.is_valid and vec_id.is_valid and values.null_count == 0:
                array = np.asarray(values.to_numpy(zero_copy_only=False), dtype="<f8") + 0.0
                if array.any() and np.isfinite(array).all():
                    vec = array.tobytes()
                    key = hashlib.sha1(repr(label).encode() + b"|" + vec).digest()
            vecs.append(vec)
            keys.append(key)
        columns = [batch.column("vec_id"), batch.column("label"), vecs, keys]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def encoded_vectors(embeddings: DataFrame, label: str | None = "label") -> DataFrame:
    """vec_id, label, vec (doubles as bytes) and key (equal rows have equal keys).

    vec and key are null where the id or the vector is null, or the vector is
    empty, zero or holds null or non-finite components. A row of zeros signed or
    not is zero.
    """
    named = F.col(label).cast("string") if label else F.lit(None).cast("string")
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), named.alias("label"), "embedding"
    )
    return rows.mapInArrow(_encoded, _USABLE)


def matrix(blobs) -> np.ndarray:
    """Rows of equally long byte strings as a matrix of doubles."""
    return np.frombuffer(b"".join(blobs), dtype="<f8").reshape(len(blobs), -1)
