"""Captions in pictures: letters of five by seven pixels, drawn into arrays."""

from __future__ import annotations

import numpy as np

#: The seven rows of each letter, five bits to a row, the leftmost the most significant.
ROWS = {
    " ": "00 00 00 00 00 00 00", "0": "0E 11 13 15 19 11 0E", "1": "04 0C 04 04 04 04 0E", "2": "0E 11 01 02 04 08 1F", "3": "1F 02 04 02 01 11 0E",
    "4": "02 06 0A 12 1F 02 02", "5": "1F 10 1E 01 01 11 0E", "6": "06 08 10 1E 11 11 0E", "7": "1F 01 02 04 08 08 08", "8": "0E 11 11 0E 11 11 0E",
    "9": "0E 11 11 0F 01 02 0C", "A": "0E 11 11 1F 11 11 11", "B": "1E 11 11 1E 11 11 1E", "C": "0E 11 10 10 10 11 0E", "D": "1E 11 11 11 11 11 1E",
    "E": "1F 10 10 1E 10 10 1F", "F": "1F 10 10 1E 10 10 10", "G": "0E 11 10 17 11 11 0F", "H": "11 11 11 1F 11 11 11", "I": "0E 04 04 04 04 04 0E",
    "J": "07 02 02 02 02 12 0C", "K": "11 12 14 18 14 12 11", "L": "10 10 10 10 10 10 1F", "M": "11 1B 15 15 11 11 11", "N": "11 19 15 13 11 11 11",
    "O": "0E 11 11 11 11 11 0E", "P": "1E 11 11 1E 10 10 10", "Q": "0E 11 11 11 15 12 0D", "R": "1E 11 11 1E 14 12 11", "S": "0F 10 10 0E 01 01 1E",
    "T": "1F 04 04 04 04 04 04", "U": "11 11 11 11 11 11 0E", "V": "11 11 11 11 11 0A 04", "W": "11 11 11 15 15 1B 11", "X": "11 11 0A 04 0A 11 11",
    "Y": "11 11 0A 04 04 04 04", "Z": "1F 01 02 04 08 10 1F", ".": "00 00 00 00 00 0C 0C", "_": "00 00 00 00 00 00 1F", "-": "00 00 00 1F 00 00 00",
    ":": "00 0C 0C 00 0C 0C 00", "%": "18 19 02 04 08 13 03", "?": "0E 11 01 02 04 00 04",
}
WIDTH, HEIGHT, GAP, EDGE = 5, 7, 1, 2
_SET = {c: np.unpackbits(np.array([[int(r, 16) << 3] for r in rows.split()], np.uint8), axis=1)[:, :WIDTH].astype(bool) for c, rows in ROWS.items()}


def mask(text: str, scale: int = 1) -> np.ndarray:
    """Which pixels of a line of text are set. Small letters look like great ones, what has no letter like a question mark."""
    gap = np.zeros((HEIGHT, GAP), bool)
    parts = [part for c in text.upper() for part in (_SET.get(c, _SET["?"]), gap)][:-1]
    line = np.hstack(parts) if parts else np.zeros((HEIGHT, 0), bool)
    return line.repeat(scale, 0).repeat(scale, 1)


def caption(image: np.ndarray, x: int, y: int, text: str, colour: tuple[int, int, int], scale: int = 1) -> None:
    """Writes ``text`` on a bar of ``colour`` whose lower left corner is at (x, y), or below it at the upper edge; cut off at the edges."""
    line = mask(text, scale)
    if not line.size:
        return
    height, width = line.shape[0] + 2 * EDGE, line.shape[1] + 2 * EDGE
    top, left = (y - height if y >= height else y), max(0, min(x, image.shape[1] - width))
    bar = np.empty((height, width, 3), np.uint8)
    bar[:] = colour
    dark = (255, 255, 255) if sum(colour) < 384 else (0, 0, 0)
    bar[EDGE:-EDGE, EDGE:-EDGE][line] = dark
    top = max(0, min(top, image.shape[0]))
    there = image[top : top + height, left : left + width]
    there[:] = bar[: there.shape[0], : there.shape[1]]
