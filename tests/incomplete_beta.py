"""p-values by the regularised incomplete beta function, to check the column form against."""

import math


def _log_beta(a: float, b: float) -> float:
    """log B(a, b); the difference of two large log-gammas comes from its expansion, where it would cancel."""
    a, b = max(a, b), min(a, b)
    if a > 1e4 and b == 0.5:
        return math.lgamma(0.5) - (0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3))
    return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)


def _incomplete_beta(a: float, b: float, x: float, y: float) -> float:
    """Regularised incomplete beta function at x = 1 - y by its continued fraction (Lentz's method)."""
    if x <= 0 or y <= 0:
        return float(y <= 0)
    if x > (a + 1) / (a + b + 2):
        return 1 - _incomplete_beta(b, a, y, x)
    log_x, log_y = (math.log(u) if u < 0.5 else math.log1p(-v) for u, v in ((x, y), (y, x)))
    log_front = a * log_x + b * log_y - _log_beta(a, b)
    tiny = 1e-300
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or tiny)
    total = d
    for m in range(1, 10_000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / (1 + step * d or tiny)
            c = 1 + step / c or tiny
            change = c * d
            total *= change
        if abs(change - 1) < 1e-15:
            break
    else:
        raise ArithmeticError(f"the continued fraction did not settle for a={a}, b={b}, x={x}")
    return math.exp(log_front) * total / a


def pearson_p(r: float, n: float) -> float | None:
    if r is None or n is None or r != r or n < 3:
        return None
    return _incomplete_beta(n / 2 - 1, 0.5, max(0.0, 1 - r * r), min(1.0, r * r))
