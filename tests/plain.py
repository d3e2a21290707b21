"""Estimators written out from their definitions, slowly."""

import numpy as np


def slot_normals(day_of_year, values, reach=7):
    """Mean per day-of-year slot; slots without days on a straight line between their neighbours, or like the
    nearest at the ends; then the mean of the slots up to ``reach`` away, the year being a circle."""
    slots = [[] for _ in range(366)]
    for day, value in zip(day_of_year, values):
        if not np.isnan(value):
            slots[day - 1].append(value)
    known = [i for i, held in enumerate(slots) if held]
    line = np.interp(np.arange(366), known, [sum(slots[i]) / len(slots[i]) for i in known])
    return np.array([np.mean([line[(i + k) % 366] for k in range(-reach, reach + 1)]) for i in range(366)])


def fixed_effects(y, regressors, groups):
    """Least squares on the regressors and a dummy for every group: coefficients of the regressors, and their
    variance clustered by group with the usual factor for few groups."""
    regressors, groups = np.asarray(regressors, float), np.asarray(groups)
    names = sorted(set(groups.tolist()))
    dummies = np.array([[float(g == name) for name in names] for g in groups.tolist()])
    design = np.hstack([regressors, dummies])
    solution = np.linalg.pinv(design, rcond=1e-12)
    coefficients = solution @ y
    left = y - design @ coefficients
    n, k = regressors.shape
    variance = np.zeros((k, k))
    for name in names:
        own = groups == name
        pull = solution[:k, own] @ left[own]
        variance += np.outer(pull, pull)
    g = len(names)
    return coefficients[:k], variance * g / (g - 1) * (n - 1) / (n - k), n, g
