"""What has been worked out for chunks of text, kept in a Python worker within a memory bound."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

# Bytes of chunks and results that a worker keeps; then it starts anew.
HELD_BYTES = 96 << 20
# What it keeps between tasks.
RESTING_BYTES = 24 << 20
# A chunk longer than this is worked out each time.
LONG_CHUNK = 512
# What an entry takes besides its own bytes.
ENTRY_BYTES = 160


class ChunkCache:
    """Results per chunk. `work` gets distinct chunks that are not known yet and returns a result (bytes) for each."""

    def __init__(self, work: Callable[[list[bytes]], Iterable[bytes]], held_bytes: int = HELD_BYTES):
        self.work, self.held_bytes = work, held_bytes
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def results(self, wanted: set[bytes]) -> dict[bytes, bytes]:
        """A mapping that has all of `wanted`."""
        if self.held > self.held_bytes:
            self.known, self.held = {}, 0
        new = list(wanted.difference(self.known))
        if not new:
            return self.known
        made = dict(zip(new, self.work(new), strict=True))
        long = {c: r for c, r in made.items() if len(c) > LONG_CHUNK}
        for chunk in long:
            del made[chunk]
        self.known.update(made)
        self.held += sum(map(len, made)) + sum(map(len, made.values())) + ENTRY_BYTES * len(made)
        return {**self.known, **long} if long else self.known

    def rest(self) -> None:
        """Between tasks: give back what is more than RESTING_BYTES, as other stages run in the same worker."""
        if self.held > RESTING_BYTES:
            self.known, self.held = {}, 0

    def joined(self, texts: list[list[bytes]]) -> Iterator[bytes]:
        """For each text, given as chunks, its results one after the other."""
        found = self.results(set().union(*texts))
        for chunks in texts:
            yield b"".join(map(found.__getitem__, chunks))
