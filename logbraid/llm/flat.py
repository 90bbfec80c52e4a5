"""Runs of different lengths, one after the other in a flat array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def offsets(lengths: np.ndarray) -> np.ndarray:
    """Where each run begins, and the end of the last."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + length] one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def strings(raw: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings of these lengths in bytes, cut from `raw` one after the other."""
    ends = offsets(lengths)
    return pa.Array.from_buffers(
        pa.large_string(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(raw)]
    )


def packet(**columns: pa.Array | np.ndarray) -> bytes:
    """Columns of one length as a compressed Arrow stream, to travel in one row."""
    batch = pa.record_batch([pa.array(c) for c in columns.values()], list(columns))
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def opened(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_next_batch()
