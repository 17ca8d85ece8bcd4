"""Inverse of the standard normal CDF as a native column expression.

Wichura's algorithm AS241 (PPND16, Applied Statistics 37(3), 1988): three
rational approximations of degree 7, accurate to about 1e-16, evaluated by
Horner's rule.  The same formula is also emitted as SQL text, so another
engine can evaluate it independently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: published AS241 coefficients (highest degree first) --------
CENTRAL_NUM = (2.5090809287301226727e+3, 3.3430575583588128105e+4, 6.7265770927008700853e+4,
               4.5921953931549871457e+4, 1.3731693765509461125e+4, 1.9715909503065514427e+3,
               1.3314166789178437745e+2, 3.3871328727963666080e+0)
CENTRAL_DEN = (5.2264952788528545610e+3, 2.8729085735721942674e+4, 3.9307895800092710610e+4,
               2.1213794301586595867e+4, 5.3941960214247511077e+3, 6.8718700749205790830e+2,
               4.2313330701600911252e+1, 1.0)
MID_NUM = (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1,
           1.27045825245236838258e+0, 3.64784832476320460504e+0, 5.76949722146069140550e+0,
           4.63033784615654529590e+0, 1.42343711074968357734e+0)
MID_DEN = (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2,
           1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e+0,
           2.05319162663775882187e+0, 1.0)
TAIL_NUM = (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3,
            2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e+0,
            5.46378491116411436990e+0, 6.65790464350110377720e+0)
TAIL_DEN = (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5,
            7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1,
            5.99832206555887937690e-1, 1.0)
CENTRAL_LIMIT, CENTRAL_SHIFT, MID_LIMIT, MID_SHIFT, TAIL_SHIFT = 0.425, 0.180625, 5.0, 1.6, 5.0


def _horner(coefs, x, ops):
    acc = ops["lit"](coefs[0])
    for c in coefs[1:]:
        acc = ops["add"](ops["mul"](acc, x), ops["lit"](c))
    return acc


def _build(p, ops):
    lit, add, sub, mul, div = ops["lit"], ops["add"], ops["sub"], ops["mul"], ops["div"]
    q = sub(p, lit(0.5))
    r0 = sub(lit(CENTRAL_SHIFT), mul(q, q))
    central = div(mul(_horner(CENTRAL_NUM, r0, ops), q), _horner(CENTRAL_DEN, r0, ops))
    # distance into the nearer tail
    rt = ops["sqrt"](ops["neg"](ops["log"](ops["if_"](ops["le"](q, lit(0.0)), p, sub(lit(1.0), p)))))
    r1 = sub(rt, lit(MID_SHIFT))
    mid = div(_horner(MID_NUM, r1, ops), _horner(MID_DEN, r1, ops))
    r2 = sub(rt, lit(TAIL_SHIFT))
    tail = div(_horner(TAIL_NUM, r2, ops), _horner(TAIL_DEN, r2, ops))
    outer = ops["if_"](ops["le"](rt, lit(MID_LIMIT)), mid, tail)
    signed = ops["if_"](ops["lt"](q, lit(0.0)), ops["neg"](outer), outer)
    return ops["if_"](ops["le"](ops["abs"](q), lit(CENTRAL_LIMIT)), central, signed)


_SPARK_OPS = {
    "lit": F.lit, "add": lambda a, b: a + b, "sub": lambda a, b: a - b,
    "mul": lambda a, b: a * b, "div": lambda a, b: a / b, "neg": lambda a: -a,
    "sqrt": F.sqrt, "log": F.log, "abs": F.abs,
    "le": lambda a, b: a <= b, "lt": lambda a, b: a < b,
    "if_": lambda c, a, b: F.when(c, a).otherwise(b),
}

_SQL_OPS = {
    "lit": lambda v: f"CAST({v!r} AS DOUBLE)", "add": lambda a, b: f"({a} + {b})",
    "sub": lambda a, b: f"({a} - {b})", "mul": lambda a, b: f"({a} * {b})",
    "div": lambda a, b: f"({a} / {b})", "neg": lambda a: f"(-{a})",
    "sqrt": lambda a: f"sqrt({a})", "log": lambda a: f"ln({a})", "abs": lambda a: f"abs({a})",
    "le": lambda a, b: f"({a} <= {b})", "lt": lambda a, b: f"({a} < {b})",
    "if_": lambda c, a, b: f"(CASE WHEN {c} THEN {a} ELSE {b} END)",
}


def norm_ppf(p: Column) -> Column:
    """z with Phi(z) = p, for 0 < p < 1 (NULL outside)."""
    return F.when((p <= 0) | (p >= 1), F.lit(None).cast("double")).otherwise(_build(p, _SPARK_OPS))


def norm_ppf_sql(p: str) -> str:
    """The same algorithm as SQL text over the expression ``p``."""
    return f"(CASE WHEN ({p}) <= 0 OR ({p}) >= 1 THEN NULL ELSE {_build(f'({p})', _SQL_OPS)} END)"
