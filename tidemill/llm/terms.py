"""Terms of a text: runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased."""

from __future__ import annotations

from collections.abc import Iterator

#: The same as a pattern over characters.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of a text that are cut into terms at once.
SLICE_BYTES = 1 << 22

_KEPT = {*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)}
_UPPER = {b: b + 32 for b in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
_TABLE = bytes(_UPPER.get(b, b if b in _KEPT else 0x20) for b in range(256))


def term_slices(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text in order, as UTF-8; a very long text in several lists. Null has none."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
    at = 0
    while len(data) - at > SLICE_BYTES:
        cut = data.find(b" ", at + SLICE_BYTES)
        if cut < 0:
            break
        yield data[at:cut].split()
        at = cut
    yield data[at:].split()
