"""Linear probability models fitted on the driver to bounded samples."""

import numpy as np


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_logistic(rows, target, ridge=1.0, rounds=25):
    """Weights (last: intercept) of a ridge-penalised logistic regression by Newton steps.

    rows: dense (samples, features), target: probabilities. No rows give zero weights.
    """
    x = np.hstack([rows, np.ones((len(rows), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        slope = x.T @ (p - target) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w
