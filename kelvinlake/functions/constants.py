"""Physical constants, bounds and flag bits. Fixed values."""

L0 = 2.44e-8  # Sommerfeld Lorenz number, W Ohm / K^2
L0_NONDEGENERATE = 1.48e-8
L_MIN, L_MAX = 1e-9, 1e-7
S_MAX, SIGMA_MAX, KAPPA_MAX = 1e-3, 1e7, 100.0
T_MIN, T_MAX = 100.0, 2000.0
ZT_MAX = 4.0
ZT_TOLERANCE = 0.10
ZT_FLOOR = 1e-6
EPSILON = 2.220446049250313e-16
SIGMA_RHO_TOLERANCE = 0.05
RELATIVE_ERROR = 0.05
T_BIN, T_BUCKET, GRID_STEP = 10.0, 50.0, 10.0

FLAGS = (
    "WF_VIOLATION",
    "ZT_CROSSCHECK_FAIL",
    "UNIT_UNKNOWN",
    "SIGMA_RHO_INCON",
    "LOW_CONFIDENCE_EXP",
    "INTERP_INSUFFICIENT",
    "SEEBECK_BOUND_EXCEED",
    "SIGMA_BOUND_EXCEED",
    "KAPPA_BOUND_EXCEED",
    "FIGUREID_MISMATCH",
    "DUPLICATE_SUSPECTED",
    "ALGEBRAIC_REJECT",
    "TEMPERATURE_OUT_OF_RANGE",
)
BIT = {name: 1 << i for i, name in enumerate(FLAGS)}

ALLOWED_PROPERTIES = (2, 3, 4, 5, 6, 10, 11, 12, 14, 15, 16)
#: Policy bounds in SI units: property id -> (least, most).
POLICY_BOUNDS = {
    2: (-1e-3, 1e-3),
    3: (0.0, 1e7),
    4: (0.0, 100.0),
    5: (0.0, 1e7),
    6: (0.0, 1e-2),
    10: (-1e3, 1e3),
    11: (1e18, 1e27),
    12: (0.0, 1.0),
    14: (0.0, 100.0),
    15: (0.0, 1e-2),
    16: (0.0, 4.0),
}
DOMAIN_PRIORITY = {"samples": 0, "papers": 1, "figures": 2}
