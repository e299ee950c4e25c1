"""Frames and message envelopes on Arrow arrays, for use inside tasks.

A frame is a 4-byte big-endian length and a body. The body of an envelope is a protobuf message with
``time`` (field 1, int64 milliseconds) and ``payload`` (field 2, bytes), both optional.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LENGTH = ">i"
_DOUBLE = "<d"

# Protobuf keys of the two envelope fields.
_TIME_KEY = 0x08
_PAYLOAD_KEY = 0x12


def split_frames(buf: bytes, where: str = "") -> tuple[np.ndarray, int]:
    """Starts of the complete frames in ``buf`` and the number of bytes they take."""
    starts = []
    add, unpack = starts.append, struct.Struct(_LENGTH).unpack_from
    at, size = 0, len(buf)
    while at + 4 <= size:
        (n,) = unpack(buf, at)
        if n < 0:
            raise ValueError(f"negative record length {n} at byte {at} {where}")
        if at + 4 + n > size:
            break
        add(at)
        at += 4 + n
    return np.array(starts, dtype=np.int64), at


def _slices(buf: bytes, starts: np.ndarray, ends: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """``buf[start:end]`` for each pair, as one binary array; the pairs ascend and do not overlap."""
    n = len(starts)
    edges = np.empty(2 * n + 1, dtype=np.int32)
    edges[0] = 0
    edges[1::2], edges[2::2] = starts, ends
    # Elements alternate between what lies before a slice and the slice itself.
    both = pa.Array.from_buffers(pa.binary(), 2 * n, [None, pa.py_buffer(edges), pa.py_buffer(buf)])
    picked = both.take(pa.array(np.arange(1, 2 * n, 2)))
    if missing is not None and missing.any():
        picked = pc.if_else(pa.array(missing), pa.scalar(None, pa.binary()), picked)
    return picked


def frame_bodies(buf: bytes, starts: np.ndarray, used: int) -> pa.Array:
    return _slices(buf, starts + 4, np.append(starts[1:], used).astype(np.int64))


def _varints(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Varints that begin at ``at`` and the positions after them; -1 where one does not end."""
    value = np.zeros(len(at), dtype=np.uint64)
    after = np.full(len(at), -1, dtype=np.int64)
    going = np.ones(len(at), dtype=bool)
    for k in range(10):
        position = at + k
        byte = data[np.minimum(position, len(data) - 1)].astype(np.uint64)
        going &= position < len(data)
        value = np.where(going, value | ((byte & np.uint64(0x7F)) << np.uint64(7 * k)), value)
        ends = going & (byte < 0x80)
        after[ends] = position[ends] + 1
        going &= ~ends
        if not going.any():
            break
    return value, after


def decode_envelopes(buf: bytes, starts: np.ndarray, used: int, where: str = "") -> tuple[pa.Array, pa.Array]:
    """``time`` and ``payload`` of each frame; absent fields are null, unknown ones are skipped."""
    n = len(starts)
    if n == 0:
        return pa.array([], pa.int64()), pa.array([], pa.binary())
    data = np.frombuffer(buf, dtype=np.uint8)
    begin = starts + 4
    end = np.append(starts[1:], used).astype(np.int64)
    last = len(data) - 1
    # The usual layout is time, then payload, then the end; it is decoded for all frames at once.
    time, after_time = _varints(data, begin + 1)
    length, pay_start = _varints(data, after_time + 1)
    usual = (begin < end) & (after_time > 0) & (after_time < end) & (pay_start > 0)
    usual &= data[np.minimum(begin, last)] == _TIME_KEY
    usual &= data[np.clip(after_time, 0, last)] == _PAYLOAD_KEY
    usual &= length <= np.uint64(len(data))
    pay_end = pay_start + np.where(usual, length, 0).astype(np.int64)
    usual &= pay_end == end
    no_time = np.zeros(n, dtype=bool)
    no_payload = np.zeros(n, dtype=bool)
    for i in np.flatnonzero(~usual):
        t, span = _parse_envelope(buf, int(begin[i]), int(end[i]), where)
        no_time[i], no_payload[i] = t is None, span is None
        time[i] = np.uint64((t or 0) & 0xFFFFFFFFFFFFFFFF)
        pay_start[i], pay_end[i] = span or (end[i], end[i])
    times = pa.array(time.view(np.int64), mask=no_time if no_time.any() else None)
    return times, _slices(buf, pay_start, pay_end, no_payload)


def _fields(buf: bytes, at: int, end: int, where: str):
    """Field number, wire type and value or span of each field of a protobuf message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while at < end and shift < 70:
            byte = buf[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value & 0xFFFFFFFFFFFFFFFF, at
        raise ValueError(f"broken message body at byte {at} {where}")

    while at < end:
        key, at = varint(at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = varint(at)
        else:
            if wire == 2:
                size, at = varint(at)
            elif wire in (1, 5):
                size = 8 if wire == 1 else 4
            else:
                raise ValueError(f"unknown wire type {wire} at byte {at} {where}")
            value = (at, at + size)
            at += size
            if at > end:
                raise ValueError(f"broken message body at byte {at} {where}")
        yield number, wire, value


def _parse_envelope(buf, begin, end, where):
    time = span = None
    for number, wire, value in _fields(buf, begin, end, where):
        if number == 1 and wire == 0:
            time = value
        elif number == 2 and wire == 2:
            span = value
    return time, span


# --- encoding -----------------------------------------------------------------------------------------


def _varint_bytes(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Varints as rows of ten bytes, and how many of the ten count."""
    value = value.astype(np.int64).view(np.uint64)
    out = np.zeros((len(value), 10), dtype=np.uint8)
    used = np.ones(len(value), dtype=np.int64)
    for k in range(10):
        digit = value >> np.uint64(7 * k)
        out[:, k] = digit & np.uint64(0x7F)
        if k:
            used = np.where(digit > 0, k + 1, used)
    out[np.arange(10)[None, :] < (used - 1)[:, None]] |= 0x80
    return out, used


def encode_frames(time: pa.Array | None, payload: pa.Array) -> pa.Array:
    """Complete frames, one binary value per message; without ``time`` the payload is the whole body."""
    n = len(payload)
    lengths = pc.fill_null(pc.binary_length(payload), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if time is None:
        head = lengths.astype(">i4").view(np.uint8).reshape(n, 4)
        keep = np.ones((n, 4), dtype=bool)
    else:
        has_time = pc.is_valid(time).to_numpy(zero_copy_only=False)
        has_payload = pc.is_valid(payload).to_numpy(zero_copy_only=False)
        time_bytes, time_used = _varint_bytes(pc.fill_null(time, 0).to_numpy(zero_copy_only=False))
        size_bytes, size_used = _varint_bytes(lengths)
        body = np.where(has_time, 1 + time_used, 0) + np.where(has_payload, 1 + size_used + lengths, 0)
        if len(body) and body.max() > 0x7FFFFFFF:
            raise ValueError("a message is too large for a 4-byte length")
        ten = np.arange(10)[None, :]
        head = np.concatenate(
            [
                body.astype(">i4").view(np.uint8).reshape(n, 4),
                np.full((n, 1), _TIME_KEY, dtype=np.uint8),
                time_bytes,
                np.full((n, 1), _PAYLOAD_KEY, dtype=np.uint8),
                size_bytes,
            ],
            axis=1,
        )
        keep = np.concatenate(
            [
                np.ones((n, 4), dtype=bool),
                has_time[:, None],
                has_time[:, None] & (ten < time_used[:, None]),
                has_payload[:, None],
                has_payload[:, None] & (ten < size_used[:, None]),
            ],
            axis=1,
        )
    edges = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(keep.sum(axis=1), out=edges[1:])
    heads = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(edges), pa.py_buffer(head[keep].tobytes())])
    return pc.binary_join_element_wise(heads, pc.fill_null(payload, b""), pa.scalar(b"", pa.binary()))


def frame_bytes(frames: pa.Array) -> memoryview:
    """The frames' bytes one after the other, as they lie in the array."""
    edges = np.frombuffer(frames.buffers()[1], dtype=np.int32)[frames.offset : frames.offset + len(frames) + 1]
    if len(frames) == 0:
        return memoryview(b"")
    return memoryview(frames.buffers()[2])[int(edges[0]) : int(edges[-1])]


# --- metric data points -------------------------------------------------------------------------------


def _plain_varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def encode_data_point(time: float, interval: int, unique_topics: int, messages: int) -> bytes:
    """Fields 1 to 4: double time, then three unsigned varints."""
    out = b"\x09" + struct.pack(_DOUBLE, time)
    for key, value in ((0x10, interval), (0x18, unique_topics), (0x20, messages)):
        out += bytes([key]) + _plain_varint(value)
    return out


def decode_data_point(data: bytes) -> tuple[float | None, int | None, int | None, int | None]:
    values: list = [None] * 4
    for number, wire, value in _fields(data, 0, len(data), "in a data point"):
        if number == 1 and wire == 1:
            values[0] = struct.unpack_from(_DOUBLE, data, value[0])[0]
        elif 2 <= number <= 4 and wire == 0:
            values[number - 1] = value & 0xFFFFFFFFFFFFFFFF
    return tuple(values)
