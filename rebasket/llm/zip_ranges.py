"""The directory of a ZIP file, read by ranges: no member is extracted to be found.

``read(start, size)`` returns bytes of the file.  Directories of the ZIP64 form
(many members, large members, far offsets) are followed as well.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

Read = Callable[[int, int], bytes]

# Signatures and layouts of the ZIP format.
END, END_SIGNATURE = struct.Struct("<4s4H2LH"), b"PK\x05\x06"
LOCATOR, LOCATOR_SIGNATURE = struct.Struct("<4sLQL"), b"PK\x06\x07"
END64, END64_SIGNATURE = struct.Struct("<4sQ2H2L4Q"), b"PK\x06\x06"
ENTRY, ENTRY_SIGNATURE = struct.Struct("<4s6H3L5H2L"), b"PK\x01\x02"
LOCAL, LOCAL_SIGNATURE = struct.Struct("<4s5H3L2H"), b"PK\x03\x04"
ZIP64_FIELD = 1
STORED = 0
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
LONGEST_COMMENT = 0xFFFF

BLOCK = 1 << 20
"""Bytes of the central directory that are read at once."""


class DamagedArchive(ValueError):
    """A file that does not follow its format."""


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int  # as it lies in the file
    header: int  # where its local header starts

    @property
    def stored(self) -> bool:
        return self.method == STORED


@dataclass(frozen=True)
class _Directory:
    members: int
    size: int
    start: int
    shift: int  # bytes that were put before the archive


def _directory(read: Read, length: int) -> _Directory:
    tail_start = max(0, length - END.size - LONGEST_COMMENT)
    tail = read(tail_start, length - tail_start)
    at = len(tail) - END.size
    while at >= 0:
        at = tail.rfind(END_SIGNATURE, 0, at + len(END_SIGNATURE))
        if at < 0 or at + END.size + END.unpack_from(tail, at)[-1] == len(tail):
            break
        at -= 1
    if at < 0:
        raise DamagedArchive("no end of a central directory")
    *_, members, size, start, _ = END.unpack_from(tail, at)
    end = tail_start + at
    if FULL16 == members or FULL32 in (size, start):
        place = end - LOCATOR.size
        signature, _, far, _ = LOCATOR.unpack(read(place, LOCATOR.size)) if place >= 0 else (b"", 0, 0, 0)
        if signature == LOCATOR_SIGNATURE:
            # The record lies right before its locator, also where bytes were put before the archive.
            for found in (far, place - END64.size):
                record = read(found, END64.size)
                if record[:4] == END64_SIGNATURE:
                    *_, members, size, start = END64.unpack(record)
                    return _Directory(members, size, start, found - far)
            raise DamagedArchive("no ZIP64 end of the central directory")
    return _Directory(members, size, start, end - size - start)


def _far_values(extra: bytes, name: str, *values: int) -> list[int]:
    """The sizes and the offset, those that do not fit taken from the ZIP64 field."""
    field, at = b"", 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == ZIP64_FIELD:
            field = extra[at + 4 : at + 4 + size]
        at += 4 + size
    found, at = [], 0
    for value in values:
        if value == FULL32:
            if at + 8 > len(field):
                raise DamagedArchive(f"no ZIP64 field for {name}")
            value = struct.unpack_from("<Q", field, at)[0]
            at += 8
        found.append(value)
    return found


def members(read: Read, length: int) -> Iterator[Member]:
    """The members by the central directory, which is read in blocks."""
    directory = _directory(read, length)
    at, stop = directory.start + directory.shift, directory.start + directory.shift + directory.size
    buffer, found = b"", 0

    def need(size: int) -> None:
        nonlocal buffer, at
        while len(buffer) < size:
            block = read(at, min(max(BLOCK, size - len(buffer)), stop - at))
            if not block:
                raise DamagedArchive("the central directory ends early")
            buffer, at = buffer + block, at + len(block)

    while found < directory.members:
        need(ENTRY.size)
        entry = ENTRY.unpack_from(buffer)
        if entry[0] != ENTRY_SIGNATURE:
            raise DamagedArchive("no entry where the central directory has one")
        flags, method, packed, size = entry[3], entry[4], entry[8], entry[9]
        names, extras, comments = entry[10:13]
        need(ENTRY.size + names + extras + comments)
        name = buffer[ENTRY.size : ENTRY.size + names].decode("utf-8" if flags & 0x800 else "cp437")
        extra = buffer[ENTRY.size + names : ENTRY.size + names + extras]
        _, packed, header = _far_values(extra, name, size, packed, entry[16])
        buffer = buffer[ENTRY.size + names + extras + comments :]
        found += 1
        yield Member(name, method, packed, header + directory.shift)


def data_start(read: Read, member: Member) -> int:
    """Where the bytes of a member start: its local header has a length of its own."""
    header = read(member.header, LOCAL.size)
    if len(header) < LOCAL.size or header[:4] != LOCAL_SIGNATURE:
        raise DamagedArchive(f"no local header of {member.name}")
    *_, names, extras = LOCAL.unpack(header)
    return member.header + LOCAL.size + names + extras
