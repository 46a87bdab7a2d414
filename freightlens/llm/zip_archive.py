"""Members of a ZIP archive by range reads of its directory: nothing is extracted.

Reads the end record, the ZIP64 end record where the first has no room for a value,
and the central directory with its ZIP64 extra fields. A stored member is a range of
the archive, so that what lies at an offset in it can be read directly.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

STORED = 0
_END, _END64_AT, _END64, _ENTRY, _LOCAL = b"PK\5\6", b"PK\6\7", b"PK\6\6", b"PK\1\2", b"PK\3\4"
_MOST_COMMENT = 65535


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    packed: int
    size: int
    header_at: int


class ZipArchive:
    """``file`` has ``size()`` and ``read_at(n, offset)``, as pyarrow's input files do."""

    def __init__(self, file):
        self.file = file
        self.members = {m.name: m for m in self._directory()}

    def _directory(self) -> list[Member]:
        size = self.file.size()
        tail_at = max(0, size - 22 - _MOST_COMMENT - 20)
        tail = self.file.read_at(size - tail_at, tail_at)
        at = tail.rfind(_END)
        while at >= 0 and (len(tail) < at + 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] > len(tail)):
            at = tail.rfind(_END, 0, at)
        if at < 0:
            raise ValueError("no end record: not a ZIP archive, or cut short")
        count, length, start = struct.unpack_from("<HII", tail, at + 10)
        if (count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF) and at >= 20 and tail[at - 20:at - 16] == _END64_AT:
            record = self.file.read_at(56, struct.unpack_from("<Q", tail, at - 12)[0])
            if record[:4] != _END64:
                raise ValueError("no ZIP64 end record where its locator points")
            count, length, start = struct.unpack_from("<QQQ", record, 32)
        raw, members, at = self.file.read_at(length, start), [], 0
        for _ in range(count):
            if raw[at:at + 4] != _ENTRY:
                raise ValueError("the central directory is damaged")
            flags, method = struct.unpack_from("<HH", raw, at + 8)
            packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, at + 20)
            header_at = struct.unpack_from("<I", raw, at + 42)[0]
            name = raw[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            wide = self._wide(raw[at + 46 + n_name:at + 46 + n_name + n_extra])
            full, packed, header_at = (
                wide.pop(0) if value == 0xFFFFFFFF and wide else value for value in (full, packed, header_at))
            members.append(Member(name, method, packed, full, header_at))
            at += 46 + n_name + n_extra + n_comment
        return members

    @staticmethod
    def _wide(extra: bytes) -> list[int]:
        """The 64-bit values of the ZIP64 extra field, in their order."""
        at = 0
        while at + 4 <= len(extra):
            kind, size = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                return list(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            at += 4 + size
        return []

    def data_at(self, name: str) -> int:
        """Where a stored member's bytes begin in the archive."""
        member = self.members[name]
        if member.method != STORED:
            raise ValueError(f"{name} is compressed: its records have no place in the archive")
        local = self.file.read_at(30, member.header_at)
        if local[:4] != _LOCAL:
            raise ValueError(f"no header of {name} where the directory points")
        return member.header_at + 30 + sum(struct.unpack_from("<HH", local, 26))

    def read(self, name: str, offset: int = 0, size: int | None = None) -> bytes:
        """A range of a stored member."""
        member = self.members[name]
        size = member.size - offset if size is None else size
        if offset < 0 or offset + size > member.size:
            raise ValueError(f"{name} has {member.size} bytes, not {offset + size}")
        return self.file.read_at(size, self.data_at(name) + offset)
