"""Quality-control limits and class boundaries.

FIXED VALUES — these must equal the values the original application uses, so
results match. They are stated here once, in natural order; every rule in the
library reads them from this module.
"""

from __future__ import annotations

# Depth-layer upper edges in metres (inclusive); anything deeper, or a NULL depth,
# is "deep_ocean".
LAYER_EDGES = [
    ("surface", 10.0),
    ("mixed_layer", 100.0),
    ("mesopelagic", 1000.0),
]
DEEPEST_LAYER = "deep_ocean"
LAYERS = [name for name, _ in LAYER_EDGES] + [DEEPEST_LAYER]

# Range limits, inclusive, as {measurement column: {layer or "*": (low, high)}}.
# "*" applies to every layer.
BOUNDS = {
    "temperature": {
        "surface": (-2.0, 35.0),
        "mixed_layer": (-2.0, 30.0),
        "mesopelagic": (-2.0, 25.0),
        "deep_ocean": (-2.0, 20.0),
    },
    "salinity": {"*": (28.0, 41.0)},
    "dissolved_oxygen": {
        "surface": (4.0, 12.0),
        "mixed_layer": (2.0, 10.0),
        "mesopelagic": (0.5, 8.0),
        "deep_ocean": (0.1, 6.0),
    },
    "ph": {"*": (7.0, 8.5)},
    "turbidity": {"*": (0.0, 50.0)},
    "chlorophyll": {
        "surface": (0.0, 50.0),
        "mixed_layer": (0.0, 20.0),
        "mesopelagic": (0.0, 5.0),
        "deep_ocean": (0.0, 1.0),
    },
    "current_speed": {"*": (0.0, 3.0)},
}

# Output flag name per bounded measurement.
BOUND_FLAG_NAMES = {
    "temperature": "temp_qc_flag",
    "salinity": "salinity_qc_flag",
    "dissolved_oxygen": "oxygen_qc_flag",
    "ph": "ph_qc_flag",
    "turbidity": "turbidity_qc_flag",
    "chlorophyll": "chlorophyll_qc_flag",
    "current_speed": "current_speed_qc_flag",
}

# Largest allowed vertical change per metre, with the output flag name.
GRADIENT_LIMITS = {
    "temperature": ("temp_gradient_qc", 0.5),
    "salinity": ("salinity_gradient_qc", 0.2),
    "dissolved_oxygen": ("oxygen_gradient_qc", 0.5),
}

# Derived quantities: density = 1000 + 0.8*S - 0.2*T;
# oxygen saturation = DO / (14.6 - 0.4*T).
DENSITY_BASE, DENSITY_SALINITY, DENSITY_TEMPERATURE = 1000.0, 0.8, 0.2
O2_SAT_BASE, O2_SAT_TEMPERATURE = 14.6, 0.4

# Measurement-count classes: >= 10 high, >= 5 medium, else low.
DATA_QUALITY_CLASSES = [("high", 10), ("medium", 5)]
DATA_QUALITY_DEFAULT = "low"

# Score = 100 - 5 * (sum of the five failure counts); classes by lower edge.
QC_SCORE_START, QC_SCORE_PENALTY = 100, 5
QC_SCORE_FAILURES = [
    "temp_qc_failures",
    "salinity_qc_failures",
    "oxygen_qc_failures",
    "ph_qc_failures",
    "gradient_qc_failures",
]
QUALITY_CATEGORIES = [("excellent", 95), ("good", 85), ("fair", 75)]
QUALITY_CATEGORY_DEFAULT = "poor"

# Stream defaults: 1-hour tumbling windows, 15-minute watermark.
WINDOW_DURATION = "1 hour"
WATERMARK_DELAY = "15 minutes"

# Float profiles: depth = pressure * 10.
PRESSURE_TO_DEPTH = 10.0

# Minimum whitespace fields of a station-file data row.
STATION_MIN_FIELDS = 15
