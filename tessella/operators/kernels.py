"""Array arithmetic on batches of tiles, called from Spark tasks."""

from __future__ import annotations

import numpy as np


def _least_steps(cost: np.ndarray, axis: int) -> np.ndarray:
    """Least cost of any pixel along an axis plus the steps to it: two running minima."""
    shape = [1] * cost.ndim
    shape[axis] = cost.shape[axis]
    place = np.arange(cost.shape[axis], dtype=cost.dtype).reshape(shape)
    ahead = np.minimum.accumulate(cost - place, axis=axis) + place
    back = np.flip(np.minimum.accumulate(np.flip(cost + place, axis), axis=axis), axis) - place
    return np.minimum(ahead, back)


def dilate(mask: np.ndarray, n: int) -> np.ndarray:
    """Pixels of boolean rasters (..., h, w) within city-block distance ``n`` of a set one."""
    far = sum(mask.shape[-2:]) + max(n, 0) + 1
    distance = np.where(mask, 0, far).astype(np.int64)
    return _least_steps(_least_steps(distance, mask.ndim - 1), mask.ndim - 2) <= max(n, 0)


def stack_median(stack: np.ndarray) -> np.ndarray:
    """Median of the values other than 0 of stacks (..., depth, n), half to even; 0 where none."""
    none = np.iinfo(np.int64).max
    ordered = np.sort(np.where(stack == 0, none, stack.astype(np.int64)), axis=-2)  # missing values last
    clear = (stack != 0).sum(axis=-2, keepdims=True)
    pick = lambda at: np.take_along_axis(ordered, np.minimum(at, ordered.shape[-2] - 1), axis=-2).astype(np.float64)
    middle = (pick(np.maximum(clear - 1, 0) // 2) + pick(clear // 2)) / 2.0
    return np.squeeze(np.where(clear > 0, np.rint(middle), 0), axis=-2).astype(np.int32)


def first_nonzero(stack: np.ndarray) -> np.ndarray:
    """First value other than 0 of stacks (..., depth, n); 0 where none."""
    at = np.argmax(stack != 0, axis=-2)
    return np.take_along_axis(stack, at[..., None, :], axis=-2).squeeze(-2).astype(np.int32)


def alpha_over(base: np.ndarray, top: np.ndarray) -> np.ndarray:
    """RGBA images (..., 4, h, w) over others, channels of 8 bits rounded half up."""
    ta, ba = (a[..., 3:4, :, :].astype(np.float64) for a in (top, base))
    share = ba * (255.0 - ta)
    alpha = ta * 255.0 + share
    mixed = (top[..., :3, :, :] * (ta * 255.0) + base[..., :3, :, :] * share) / np.where(alpha == 0, 1.0, alpha)
    colours = np.where(alpha == 0, 0.0, np.floor(mixed + 0.5))
    return np.concatenate([colours, np.floor(alpha / 255.0 + 0.5)], axis=-3).astype(np.int32)


def _sinc(t, a=3.0):
    return np.where(np.abs(t) < a, np.sinc(t) * np.sinc(t / a), 0.0)


def _cubic(t, b=-0.5):
    t = np.abs(t)
    near = (b + 2) * t**3 - (b + 3) * t**2 + 1
    far = b * t**3 - 5 * b * t**2 + 8 * b * t - 4 * b
    return np.where(t <= 1, near, np.where(t < 2, far, 0.0))


def _spline(t):
    t = np.abs(t)
    return np.where(t < 1, 2 / 3 - t**2 + t**3 / 2, np.where(t < 2, (2 - t) ** 3 / 6, 0.0))


def _gauss(t):
    return np.exp(-2.0 * t**2) * (np.abs(t) < 1.5)


KERNELS = {"lanczos": (_sinc, 3.0), "cubic": (_cubic, 2.0), "cubicspline": (_spline, 2.0), "gauss": (_gauss, 1.5)}


def _weights(src: int, dst: int, method: str) -> np.ndarray:
    """Matrix (dst, src) of a separable resampling, edges clamped."""
    kernel, reach = KERNELS[method]
    scale = max(src / dst, 1.0)
    centre = (np.arange(dst) + 0.5) * src / dst - 0.5
    matrix = np.zeros((dst, src))
    for offset in range(-int(np.ceil(reach * scale)), int(np.ceil(reach * scale)) + 1):
        at = np.floor(centre).astype(int) + offset
        weight = kernel((at - centre) / scale)
        np.add.at(matrix, (np.arange(dst), np.clip(at, 0, src - 1)), weight)
    return matrix / matrix.sum(axis=1, keepdims=True)


def resize(image: np.ndarray, h: int, w: int, method: str = "nearest", rgba: bool = False, limits: tuple[int, int] | None = None) -> np.ndarray:
    """Resize planes (p, H, W); colours are weighted by alpha if the planes are RGBA.

    ``limits`` are the least and greatest value of the data's type, which smooth kernels
    may overshoot; without them the array's own type bounds the result.
    """
    _, src_h, src_w = image.shape
    if (src_h, src_w) == (h, w):
        return image
    if method == "nearest":
        rows = np.arange(h) * src_h // h
        cols = np.arange(w) * src_w // w
        return image[:, rows][:, :, cols]
    rows, cols = _weights(src_h, h, method), _weights(src_w, w, method)
    work = image.astype(np.float64)
    if rgba:
        work[:3] *= work[3] / 255.0
    out = np.einsum("ij,pjk,lk->pil", rows, work, cols)
    if rgba:
        alpha = np.where(out[3] > 0, out[3] / 255.0, 1.0)
        out[:3] = out[:3] / alpha
    low, high = limits or (np.iinfo(image.dtype).min, np.iinfo(image.dtype).max)
    return np.clip(np.floor(out + 0.5), low, high).astype(image.dtype)


def _quads(image: np.ndarray) -> np.ndarray:
    return np.stack([image[..., i::2, j::2] for i in (0, 1) for j in (0, 1)])


def _mean_of_four(image: np.ndarray, rgba: bool, nodata: int | None) -> np.ndarray:
    quads = _quads(image).astype(np.float64)
    if rgba:
        alpha = quads[..., 3:4, :, :]
        total = alpha.sum(axis=0)
        colour = (quads[..., :3, :, :] * alpha).sum(axis=0) / np.where(total > 0, total, 1.0)
        return np.rint(np.concatenate([colour, total / 4.0], axis=-3)).astype(image.dtype)
    clear = np.ones(quads.shape, bool) if nodata is None else quads != nodata
    count = clear.sum(axis=0)
    mean = np.where(clear, quads, 0.0).sum(axis=0) / np.maximum(count, 1)
    return np.where(count > 0, np.rint(mean), nodata or 0).astype(image.dtype)


def _most_of_four(image: np.ndarray, rgba: bool, nodata: int | None) -> np.ndarray:
    """The most frequent of four values (of RGBA: of the visible pixels), the lowest of several."""
    quads = _quads(image).astype(np.int64)
    if rgba:
        quads = ((quads[..., 0, :, :] * 256 + quads[..., 1, :, :]) * 256 + quads[..., 2, :, :]) * 256 + quads[..., 3, :, :]
        clear = quads % 256 > 0
    else:
        clear = np.ones(quads.shape, bool) if nodata is None else quads != nodata
    votes = ((quads[:, None] == quads[None, :]) & clear[None]).sum(axis=1) * clear
    lowest = np.where((votes == votes.max(axis=0)) & clear, quads, np.iinfo(np.int64).max).min(axis=0)
    lowest = np.where(clear.any(axis=0), lowest, 0 if rgba else nodata or 0)
    if not rgba:
        return lowest.astype(image.dtype)
    return np.stack([lowest >> shift & 255 for shift in (24, 16, 8, 0)], axis=-3).astype(image.dtype)


def halve(image: np.ndarray, method: str, rgba: bool = False, nodata: int | None = None, limits: tuple[int, int] | None = None) -> np.ndarray:
    """Images (..., planes, 2h, 2w) to half size.

    Averages of RGBA weight the colours by alpha. Else values equal to ``nodata`` (none by
    default) do not count for average and mode; a pixel of nothing else stays nodata.
    """
    *lead, h, w = image.shape
    if method == "nearest":
        return image[..., ::2, ::2].copy()
    if method == "average":
        return _mean_of_four(image, rgba, nodata)
    if method == "mode":
        return _most_of_four(image, rgba, nodata)
    planes = image.reshape(-1, lead[-1] if lead else 1, h, w)
    kernel = method if method in KERNELS else "cubic"
    return np.stack([resize(p, h // 2, w // 2, kernel, rgba, limits) for p in planes]).reshape(*lead, h // 2, w // 2)


def hillshade(elev: np.ndarray, cell_x: float, cell_y: float, azimuth=315.0, altitude=45.0) -> np.ndarray:
    """Shade of the inner pixels of rasters (..., h, w) padded by one (third-order gradient)."""
    part = lambda rows, cols: elev[..., rows, cols]
    first, inner, last = slice(None, -2), slice(1, -1), slice(2, None)
    a, b, c = part(first, first), part(first, inner), part(first, last)
    d, f = part(inner, first), part(inner, last)
    g, h, i = part(last, first), part(last, inner), part(last, last)
    dx = ((c + 2 * f + i) - (a + 2 * d + g)) / (8.0 * cell_x)
    dy = ((g + 2 * h + i) - (a + 2 * b + c)) / (8.0 * cell_y)
    zenith, az = np.radians(90.0 - altitude), np.radians(360.0 - azimuth + 90.0)
    slope, aspect = np.arctan(np.hypot(dx, dy)), np.arctan2(dy, -dx)
    shade = np.cos(zenith) * np.cos(slope) + np.sin(zenith) * np.sin(slope) * np.cos(az - aspect)
    return np.clip(np.floor(1.0 + 254.0 * np.maximum(shade, 0.0) + 0.5), 1, 255).astype(np.int32)


def windows(images: np.ndarray, depth: int, sx: np.ndarray, sy: np.ndarray, size: int) -> np.ndarray:
    """Nearest-neighbour tiles of descendants ``depth`` zooms below images (k, p, h, w).

    ``sx``, ``sy`` are the descendants' offsets. Where a window would be smaller than a
    pixel, it is the pixel that contains it.
    """
    k, p, h, w = images.shape
    wide, high = w >> depth, h >> depth
    x0 = sx * wide if wide else (sx * w) >> depth
    y0 = sy * high if high else (sy * h) >> depth
    cols = x0[:, None] + np.arange(size)[None, :] * max(wide, 1) // size
    rows = y0[:, None] + np.arange(size)[None, :] * max(high, 1) // size
    at = np.arange(k)[:, None, None, None]
    return images[at, np.arange(p)[None, :, None, None], rows[:, None, :, None], cols[:, None, None, :]]


def window(image: np.ndarray, depth: int, sx: int, sy: int) -> np.ndarray:
    """The same window of one image, unscaled."""
    _, h, w = image.shape
    wide, high = w >> depth, h >> depth
    x0 = sx * wide if wide else (sx * w) >> depth
    y0 = sy * high if high else (sy * h) >> depth
    return image[:, y0 : y0 + max(high, 1), x0 : x0 + max(wide, 1)]
