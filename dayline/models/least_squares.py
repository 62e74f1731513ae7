"""Small numeric helpers that run inside a task on one series.

Conditional least squares on lagged values; moving-average terms by the two-step regression of
Hannan and Rissanen (1982): a long autoregression gives innovations, whose lags then enter as
regressors. Seasonal lags are additive. This is not maximum likelihood.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from dayline.models.grid import Config


class Solution(NamedTuple):
    names: list[str]
    coef: np.ndarray
    n: int
    rss: float
    resid: np.ndarray  # on the differenced scale, NaN where lags are missing

    @property
    def sigma2(self) -> float:
        return self.rss / self.n


def solve_normal(gram: np.ndarray, moment: np.ndarray) -> np.ndarray:
    """Normal equations on unit-scaled columns; redundant columns share their weight."""
    scale = np.sqrt(np.diag(gram))
    scale[scale == 0] = 1.0
    solved = np.linalg.lstsq(gram / np.outer(scale, scale), moment / scale, rcond=1e-12)[0]
    return solved / scale


def difference(a: np.ndarray, d: int, sd: int, m: int) -> np.ndarray:
    for step in [1] * d + [m] * sd:
        a = a[step:] - a[:-step]
    return a


def shifted(v: np.ndarray, lags: list[int]) -> np.ndarray:
    out = np.full((len(v), len(lags)), np.nan)
    for j, k in enumerate(lags):
        out[k:, j] = v[:-k] if k < len(v) else v[:0]
    return out


def regress(target: np.ndarray, design: np.ndarray) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Coefficients, residuals (NaN on unusable rows) and rows used; None if there are too few."""
    # rows are unusable where lags are missing, that is at the start
    usable = np.isfinite(design.sum(axis=1) + target)
    first = int(np.argmax(usable)) if usable.any() else len(target)
    x, y = design[first:], target[first:]
    if not usable[first:].all():
        x, y = x[usable[first:]], y[usable[first:]]
    n, k = x.shape
    if n <= k:
        return None
    coef = solve_normal(x.T @ x, x.T @ y) if k else np.zeros(0)
    resid = np.full(len(target), np.nan)
    resid[usable] = y - x @ coef
    return coef, resid, n


def innovations(w: np.ndarray, x: np.ndarray, order: int) -> np.ndarray | None:
    """Residuals of a long autoregression with constant."""
    design = np.column_stack([np.ones(len(w)), shifted(w, list(range(1, order + 1))), x])
    done = regress(w, design)
    return None if done is None else done[1]


def long_order(cfg: Config, n: int) -> int:
    wanted = max([10, *cfg.ar_lags, *cfg.ma_lags])
    return max(1, min(wanted, n // 4))


def design_matrix(cfg: Config, w: np.ndarray, x: np.ndarray, e: np.ndarray | None
                  ) -> tuple[np.ndarray, list[str]]:
    blocks, names = [], []
    if "c" in cfg.trend:
        blocks.append(np.ones((len(w), 1)))
        names.append("intercept")
    if "t" in cfg.trend:
        blocks.append(np.arange(1.0, len(w) + 1)[:, None])
        names.append("drift")
    blocks.append(shifted(w, cfg.ar_lags))
    names += [f"ar.L{k}" for k in cfg.ar_lags]
    if e is not None:
        blocks.append(shifted(e, cfg.ma_lags))
        names += [f"ma.L{k}" for k in cfg.ma_lags]
    blocks.append(x)
    names += [f"x{j}" for j in range(x.shape[1])]
    return np.column_stack(blocks), names


def first_day(cfg: Config, n: int) -> int:
    """The first of ``n`` days that a configuration can use: differences, innovations and lags come before it."""
    lost = cfg.d + cfg.sd * cfg.m
    before = long_order(cfg, n - lost) + max(cfg.ma_lags) if cfg.ma_lags else 0
    return lost + max([before, 0, *cfg.ar_lags])


def fit_series(cfg: Config, y: np.ndarray, x: np.ndarray,
               noise: dict | None = None, first: int = 0) -> Solution | None:
    """Fit one configuration to one series; None if it is invalid or the series too short.

    ``noise`` remembers innovations between configurations fitted to the same rows. Days before
    ``first`` serve as lags only.
    """
    if not cfg.valid or len(y) <= cfg.d + cfg.sd * cfg.m + 2:
        return None
    w, dx = (difference(a, cfg.d, cfg.sd, cfg.m) for a in (y, x))
    e = None
    if cfg.ma_lags:
        slot = (cfg.d, cfg.sd, cfg.m if cfg.sd else 0, long_order(cfg, len(w)))
        noise = {} if noise is None else noise
        if slot not in noise:
            noise[slot] = innovations(w, dx, slot[-1])
        e = noise[slot]
        if e is None:
            return None
    design, names = design_matrix(cfg, w, dx, e)
    target = w.copy()
    target[:max(0, first - (len(y) - len(w)))] = np.nan
    done = regress(target, design)
    if done is None:
        return None
    coef, resid, n = done
    return Solution(names, coef, n, float(np.nansum(resid ** 2)), resid)


def _by_lag(fit: Solution, prefix: str, lags: list[int]) -> list[tuple[int, float]]:
    value = dict(zip(fit.names, fit.coef.tolist()))
    return [(k, value[f"{prefix}.L{k}"]) for k in lags]


def _differencing(cfg: Config) -> np.ndarray:
    """Coefficients of the differences as one polynomial, the leading 1 included."""
    unit = np.ones(1)
    for step in [1] * cfg.d + [cfg.m] * cfg.sd:
        unit = np.convolve(unit, np.concatenate([[1.0], np.zeros(step - 1), [-1.0]]))
    return unit


def forecast_path(cfg: Config, fit: Solution, y: np.ndarray, x: np.ndarray,
                  future: np.ndarray) -> np.ndarray:
    """Expected values for ``len(future)`` steps, on the scale the model was fitted."""
    ar, ma = _by_lag(fit, "ar", cfg.ar_lags), _by_lag(fit, "ma", cfg.ma_lags)
    value = dict(zip(fit.names, fit.coef.tolist()))
    start, slope = value.get("intercept", 0.0), value.get("drift", 0.0)
    drop, length = cfg.d + cfg.sd * cfg.m, len(y) - cfg.d - cfg.sd * cfg.m
    reach = max([1, *cfg.ar_lags, *cfg.ma_lags])
    push = np.zeros(len(future))
    beta = [c for n, c in value.items() if n[0] == "x"]
    if beta:
        recent = np.vstack([x[len(x) - drop:], future])
        push = difference(recent, cfg.d, cfg.sd, cfg.m) @ np.array(beta)

    # only the last values matter, so only they become lists
    w = difference(y[-(reach + drop):], cfg.d, cfg.sd, cfg.m).tolist()
    e = np.nan_to_num(fit.resid[-reach:]).tolist()
    levels = y[len(y) - drop:].tolist()
    undo = [(k, c) for k, c in enumerate(_differencing(cfg).tolist()) if k and c]
    path = []
    for h in range(len(future)):
        step = start + slope * (length + h + 1) + push[h]
        for k, c in ar:
            step += c * w[-k]
        for k, c in ma:
            step += c * e[-k]
        w.append(step)
        e.append(0.0)
        for k, c in undo:
            step -= c * levels[-k]
        levels.append(step)
        path.append(step)
    return np.array(path)


def forecast_error(cfg: Config, fit: Solution, steps: int) -> np.ndarray:
    """Standard errors of the path, from the weights of past innovations."""
    ar = np.zeros(max(cfg.ar_lags, default=0) + 1)
    ar[0] = 1.0
    for k, c in _by_lag(fit, "ar", cfg.ar_lags):
        ar[k] = -c
    ma = dict(_by_lag(fit, "ma", cfg.ma_lags))
    full = np.convolve(ar, _differencing(cfg))
    psi = np.zeros(steps)
    for j in range(steps):
        psi[j] = 1.0 if j == 0 else ma.get(j, 0.0)
        psi[j] -= sum(full[k] * psi[j - k] for k in range(1, min(j, len(full) - 1) + 1))
    return np.sqrt(fit.sigma2 * np.cumsum(psi ** 2))


def forecast_series(cfg: Config, fit: Solution, y: np.ndarray, x: np.ndarray,
                    future: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Path and standard errors."""
    return forecast_path(cfg, fit, y, x, future), forecast_error(cfg, fit, len(future))
