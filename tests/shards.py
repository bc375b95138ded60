"""Record shards for tests, made from dictionaries of lists."""

import struct


def number(n: int) -> bytes:
    """A whole number, seven bits to a byte, the last byte without its top bit."""
    groups = [n >> k & 0x7F for k in range(0, max(n.bit_length(), 1), 7)]
    return bytes([g | 0x80 for g in groups[:-1]] + groups[-1:])


def part(field: int, data: bytes) -> bytes:
    return number(field * 8 + 2) + number(len(data)) + data


def values(kind: type, items: list) -> bytes:
    if kind is bytes:
        return part(1, b"".join(part(1, x) for x in items))
    if kind is float:
        return part(2, part(1, struct.pack(f"<{len(items)}f", *items)))
    return part(3, part(1, b"".join(number(x % 2**64) for x in items)))


def payload(example: dict[str, list]) -> bytes:
    features = [part(1, part(1, name.encode()) + part(2, values(type(items[0]), items))) for name, items in example.items()]
    return part(1, b"".join(features))


def write(path: str, examples: list[dict[str, list]]) -> None:
    """Checksums are left empty, as the reader does not look at them."""
    with open(path, "wb") as f:
        for data in map(payload, examples):
            f.write(struct.pack("<QI", len(data), 0) + data + bytes(4))
