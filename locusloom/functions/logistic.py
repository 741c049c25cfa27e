"""L2-penalised logistic regression in sample space.

The fit depends on the features only through the products of sample rows, so a
``samples x samples`` matrix K replaces the gene columns: scores are ``K @ a`` and the
penalty is ``a' K a / 2``.
"""

from __future__ import annotations

import numpy as np


def _loss(k, a, b, y, weight):
    f = k @ a + b
    return 0.5 * a @ k @ a + np.sum(weight * (np.logaddexp(0.0, f) - y * f))


def fit(
    k: np.ndarray,
    y: np.ndarray,
    train: np.ndarray,
    weight: np.ndarray | None = None,
    free_intercept: bool = False,
    max_steps: int = 200,
) -> tuple[np.ndarray, float]:
    """Weights of the ``train`` samples and intercept of a fit on them (C = 1).

    Damped Newton steps on the optimality conditions ``a = w (y - sigmoid(K a + b))``;
    with a free intercept also ``sum(a) = 0``. For a penalised intercept add 1 to K.
    """
    kt, yt = k[np.ix_(train, train)], y[train].astype(float)
    n = len(train)
    w = np.ones(n) if weight is None else weight[train].astype(float)
    a, b = np.zeros(n), 0.0
    for _ in range(max_steps):
        p = 0.5 * (1.0 + np.tanh(0.5 * (kt @ a + b)))
        residual = a + w * (p - yt)
        curve = w * p * (1.0 - p)
        jacobian = np.eye(n) + curve[:, None] * kt
        if free_intercept:
            jacobian = np.block([[jacobian, curve[:, None]], [np.ones((1, n)), np.zeros((1, 1))]])
            step = np.linalg.lstsq(jacobian, -np.append(residual, a.sum()), rcond=None)[0]
            da, db = step[:n], step[n]
        else:
            da, db = np.linalg.solve(jacobian, -residual), 0.0
        base, scale = _loss(kt, a, b, yt, w), 1.0
        while scale > 1e-8 and _loss(kt, a + scale * da, b + scale * db, yt, w) > base + 1e-12 * (1 + abs(base)):
            scale /= 2
        a, b = a + scale * da, b + scale * db
        if max(np.max(np.abs(scale * da), initial=0.0), abs(scale * db)) < 1e-10:
            break
    return a, b


def fit_scores(k: np.ndarray, y: np.ndarray, train: np.ndarray, *options, **named) -> np.ndarray:
    """Decision scores of all samples after :func:`fit`."""
    a, b = fit(k, y, train, *options, **named)
    return k[:, train] @ a + b


def balanced_weights(y: np.ndarray, train: np.ndarray) -> np.ndarray:
    """Weights that give both classes of the training part the same total."""
    out = np.zeros(len(y))
    part = y[train]
    for c in (0, 1):
        hits = train[part == c]
        if len(hits):
            out[hits] = len(train) / (2.0 * len(hits))
    return out


def fit_many(product, y: np.ndarray, weight: np.ndarray, free_intercept: bool = False, max_steps: int = 100, max_inner: int = 500) -> np.ndarray:
    """Scores of all samples after the fits of :func:`fit`, many at once and without a matrix of samples.

    ``y`` and ``weight`` are samples x fits; a sample of weight 0 is not trained on. ``product(v, fits)``
    gives K of each of the named fits times its column of ``v``. Newton steps as in :func:`fit`; each is
    solved by conjugate gradients in the space of the features, which see K only through such products.
    A fit ends when a step changes its scores by less than a hundred-millionth.
    """
    a, b, f = np.zeros(y.shape), np.zeros(y.shape[1]), np.zeros(y.shape)
    fits = np.arange(y.shape[1])
    for _ in range(max_steps):
        yt, w = y[:, fits], weight[:, fits]
        p = 0.5 * (1.0 + np.tanh(0.5 * f[:, fits]))
        pull = w * (p - yt)
        v, vb, h = _newton_steps(product, fits, a[:, fits] + pull, pull.sum(axis=0) * free_intercept, w * p * (1.0 - p), free_intercept, max_inner)
        av, bv, fv = a[:, fits], b[fits], f[:, fits]
        # The penalty along a step is a parabola, as the products with a and v are known.
        ridge = [0.5 * np.sum(l * r, axis=0) for l, r in ((av, fv - bv), (2 * v, fv - bv), (v, h - vb))]

        def loss(t):
            g = fv + t * h
            return ridge[0] + t * ridge[1] + t * t * ridge[2] + np.sum(w * (np.logaddexp(0.0, g) - yt * g), axis=0)

        base, t = loss(np.zeros(len(fits))), np.ones(len(fits))
        while np.any(worse := (loss(t) > base + 1e-12 * (1 + np.abs(base))) & (t > 1e-8)):
            t[worse] /= 2
        a[:, fits], b[fits], f[:, fits] = av + t * v, bv + t * vb, fv + t * h
        fits = fits[np.max(np.abs(t * h) / (1 + np.abs(fv)), axis=0, initial=0.0) > 1e-8]
        if not len(fits):
            break
    return f


def _newton_steps(product, fits, g, gb, curve, free_intercept, max_inner):
    """Newton step of each fit from its gradient ``g`` (``gb`` of the intercept): its weights, intercept and change of scores."""
    r, rb, kr = -g, -gb, -product(g, fits)
    rr = np.maximum(np.sum(r * kr, axis=0) + rb * rb, 0.0)
    goal = rr * np.minimum(1e-2, np.sqrt(rr))
    d, db, kd = r, rb, kr
    v, vb, h = np.zeros(g.shape), np.zeros(g.shape[1]), np.zeros(g.shape)
    live = np.flatnonzero(rr > 0)
    r, rb, rr, d, db, kd = r[:, live], rb[live], rr[live], d[:, live], db[live], kd[:, live]
    for _ in range(max_inner):
        if not len(live):
            break
        ahead = kd + db
        bent = curve[:, live] * ahead
        along = np.sum(d * kd + bent * ahead, axis=0)
        step = np.divide(rr, along, out=np.zeros(len(live)), where=along > 0)
        v[:, live] += step * d
        vb[live] += step * db
        h[:, live] += step * ahead
        r, rb = r - step * (d + bent), rb - step * bent.sum(axis=0) * free_intercept
        kr = product(r, fits[live])
        new = np.maximum(np.sum(r * kr, axis=0) + rb * rb, 0.0)
        turn, go = new / rr, (new > goal[live]) & (along > 0)
        d, db, kd = (r + turn * d)[:, go], (rb + turn * db)[go], (kr + turn * kd)[:, go]
        r, rb, rr, live = r[:, go], rb[go], new[go], live[go]
    return v, vb, h
