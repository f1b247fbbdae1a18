"""Pictures without an image library: PNG files, mask overlays, inverse crops, numbered correspondence overlays.  Arrays are height, width, RGB."""

from __future__ import annotations

import struct
import zlib

import numpy as np

from .masks import color_for_index, inverse_background

#: Digits on a grid of three by five, a row a number.
DIGITS = ((7, 5, 5, 5, 7), (2, 6, 2, 2, 7), (7, 1, 7, 4, 7), (7, 1, 7, 1, 7), (5, 5, 7, 1, 1), (7, 4, 7, 1, 7), (7, 4, 7, 5, 7), (7, 1, 1, 1, 1), (7, 5, 7, 5, 7), (7, 5, 7, 1, 7))


def png(image: np.ndarray) -> bytes:
    """A PNG file of an RGB or a single-channel image."""
    image = np.ascontiguousarray(image, np.uint8)
    height, width = image.shape[:2]
    rows = np.hstack([np.zeros((height, 1), np.uint8), image.reshape(height, -1)]).tobytes()
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", width, height, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(rows, 6)) + part(b"IEND", b"")


def read_png(data: bytes) -> np.ndarray:
    """The image of a file as `png` writes it."""
    at, body, shape = 8, b"", None
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        chunk = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            w, h, _, color = struct.unpack(">IIBB", chunk[:10])
            shape = (h, w, 3) if color == 2 else (h, w)
        elif kind == b"IDAT":
            body += chunk
        at += 12 + n
    return np.frombuffer(zlib.decompress(body), np.uint8).reshape(shape[0], -1)[:, 1:].reshape(shape)


def overlay(image: np.ndarray, mask: np.ndarray, color: tuple[int, int, int] = (255, 64, 64), alpha: float = 0.38) -> np.ndarray:
    """The image with a colour laid over the mask."""
    out = np.asarray(image, np.float32).copy()
    out[mask] = (1 - alpha) * out[mask] + alpha * np.asarray(color, np.float32)
    return np.clip(out, 0, 255).astype(np.uint8)


def inverse_crop(image: np.ndarray, mask: np.ndarray, pad: int = 24) -> tuple[np.ndarray, dict]:
    """The mask's surroundings with everything but the mask filled by a colour far from its own; the facts of the choice."""
    facts = inverse_background(image[mask])
    ys, xs = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
    if not len(ys):
        return image[:0, :0], facts
    y, x = slice(max(0, ys[0] - pad), ys[-1] + 1 + pad), slice(max(0, xs[0] - pad), xs[-1] + 1 + pad)
    return np.where(mask[y, x, None], image[y, x], np.array(facts["rgb"], np.uint8)), facts


def resized(mask: np.ndarray, height: int, width: int) -> np.ndarray:
    """A mask at another size, by nearest pixels."""
    return mask[(np.arange(height) * mask.shape[0] // height)[:, None], np.arange(width) * mask.shape[1] // width]


def _stamp(image: np.ndarray, x: int, y: int, number: int, color, scale: int = 2) -> None:
    """A number in a framed box at a place; what lies outside the image is cut."""
    glyphs = [np.array([[row >> k & 1 for k in (2, 1, 0)] for row in DIGITS[int(c)]], bool) for c in str(number)]
    text = np.hstack([np.pad(g, ((0, 0), (0, 1))) for g in glyphs])[:, :-1].repeat(scale, 0).repeat(scale, 1)
    box = np.full((text.shape[0] + 6, text.shape[1] + 6, 3), (16, 19, 24), np.uint8)
    box[:2], box[-2:], box[:, :2], box[:, -2:] = color, color, color, color
    box[3:-3, 3:-3][text] = 255
    h, w = image[y : y + len(box), x : x + box.shape[1]].shape[:2]
    image[y : y + h, x : x + w] = box[:h, :w]


def correspondence_overlay(image: np.ndarray, masks: list[np.ndarray], boxes: list[tuple[int, int, int, int]], alpha: float = 0.38) -> np.ndarray:
    """All masks in colours of their own, each with its number from 1 at its box."""
    out = np.asarray(image, np.uint8).copy()
    for i, mask in enumerate(masks):
        out = overlay(out, mask if mask.shape == out.shape[:2] else resized(mask, *out.shape[:2]), color_for_index(i), alpha)
    for i, (x, y, _, _) in enumerate(boxes):
        _stamp(out, max(0, int(x)), max(0, int(y)), i + 1, color_for_index(i))
    return out


def all_masks(image: np.ndarray, masks: list[np.ndarray]) -> np.ndarray:
    """The image where any mask lies, black elsewhere."""
    union = np.logical_or.reduce([m if m.shape == image.shape[:2] else resized(m, *image.shape[:2]) for m in masks]) if masks else np.zeros(image.shape[:2], bool)
    return np.where(union[..., None], image, 0).astype(np.uint8)
