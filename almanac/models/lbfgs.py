"""Limited-memory BFGS with a strong Wolfe line search, step by step as Spark's own solvers take it.

Steps, constants and stopping rules are those of the solver behind Spark's perceptron, so the same objective ends
at the same weights, but for the rounding of sums.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np

Objective = Callable[[np.ndarray], tuple[float, np.ndarray]]

# Pairs of steps remembered, objectives looked back upon, Wolfe conditions, steps of a search and of its zoom.
MEMORY, LOOK_BACK = 10, 20
DECREASE, CURVATURE = 1e-4, 0.9
SEARCHES, ZOOMS = 10, 10


class NoStep(ArithmeticError):
    """No step along this direction."""


def minimise(objective: Objective, start: np.ndarray, tol: float, most: int) -> tuple[np.ndarray, int]:
    """The weights at which the search ends, and the number of steps."""
    x = start
    value, gradient = objective(x)
    first, values = value, [value]
    history: list[tuple[np.ndarray, np.ndarray]] = []
    steps, failed = 0, False
    while not _ended(steps, value, gradient, values, first, tol, most):
        try:
            direction = _direction(history, gradient)
            size = _line_search(objective, x, direction, value, gradient, 1.0 / np.linalg.norm(direction) if steps == 0 else 1.0)
            if size[0] * np.linalg.norm(gradient) < 1e-10:
                raise NoStep("the step vanishes")
        except NoStep:
            if failed:
                break
            history, failed = [], True
            continue
        length, value, after = size
        moved = x + length * direction
        history = [(moved - x, after - gradient), *history][:MEMORY]
        x, gradient, failed = moved, after, False
        values = [*values, value][-LOOK_BACK:]
        steps += 1
    return x, steps


def _ended(steps: int, value: float, gradient: np.ndarray, values: list[float], first: float, tol: float, most: int) -> bool:
    if steps >= most >= 0:
        return True
    if len(values) >= 2 and abs(value - max(values)) <= tol * abs(first):
        return True
    return float(np.linalg.norm(gradient)) <= max(tol * abs(value), 1e-8)


def _direction(history: list[tuple[np.ndarray, np.ndarray]], gradient: np.ndarray) -> np.ndarray:
    scale = 1.0
    if history:
        step, change = history[0]
        product = step @ change
        if product < 0 or math.isnan(product):
            raise NoStep("the history is not convex")
        scale = product / (change @ change)
    direction, shares = gradient.copy(), []
    for step, change in history:
        share = (step @ direction) / (step @ change)
        if math.isnan(share):
            raise NoStep("the history is not a number")
        shares.append(share)
        direction -= share * change
    direction *= scale
    for (step, change), share in zip(reversed(history), reversed(shares), strict=True):
        direction += (share - (change @ direction) / (step @ change)) * step
    return -direction


def _line_search(
    objective: Objective, x: np.ndarray, direction: np.ndarray, value: float, gradient: np.ndarray, first: float
) -> tuple[float, float, np.ndarray]:
    """Length of the step, with the objective and the gradient there."""
    slope = gradient @ direction
    if slope > 0:
        raise NoStep("not a direction of descent")

    def at(t: float) -> tuple[float, float, float, np.ndarray]:
        there, change = objective(x + t * direction)
        return t, there, change @ direction, change

    def zoom(low: tuple, high: tuple) -> tuple[float, float, np.ndarray]:
        for _ in range(ZOOMS):
            point = at(_between(high, low) if low[0] > high[0] else _between(low, high))
            if point[1] > value + DECREASE * point[0] * slope or point[1] >= low[1]:
                high = point
            else:
                if abs(point[2]) <= CURVATURE * abs(slope):
                    return point[0], point[1], point[3]
                if point[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = point
        raise NoStep("the zoom found no step")

    low, t = (0.0, value, slope, gradient), first
    for search in range(SEARCHES):
        point = at(t)
        if not math.isfinite(point[1]):
            t /= 2.0
            continue
        if point[1] > value + DECREASE * t * slope or (point[1] >= low[1] and search > 0):
            return zoom(low, point)
        if abs(point[2]) <= CURVATURE * abs(slope):
            return point[0], point[1], point[3]
        if point[2] >= 0:
            return zoom(point, low)
        low, t = point, t * 1.5
    raise NoStep("the line search found no step")


def _between(left: tuple, right: tuple) -> float:
    """The minimum of the cubic through both ends, kept off them."""
    span = right[0] - left[0]
    d1 = left[2] + right[2] - 3 * (left[1] - right[1]) / (left[0] - right[0])
    with np.errstate(invalid="ignore"):
        d2 = float(np.sqrt(np.float64(d1 * d1 - left[2] * right[2])))
    t = right[0] - span * (right[2] + d2 - d1) / (right[2] - left[2] + 2 * d2)
    lower, upper = left[0] + 0.1 * span, left[0] + 0.9 * span
    return lower if t < lower else upper if t > upper else t
