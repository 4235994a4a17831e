"""The predefined routes: ordered (latitude, longitude) waypoints."""

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# ---- fixed values: waypoints of the six routes ---------------------------------------------------
ROUTES = {
    "BA_MENDOZA": [
        (-34.6037, -58.3816),
        (-34.5706, -59.1100),
        (-34.6513, -59.4307),
        (-34.5933, -60.9467),
        (-34.2682, -62.2932),
        (-34.1272, -63.3922),
        (-33.6760, -65.4604),
        (-33.3017, -66.3378),
        (-33.0456, -67.5212),
        (-33.3100, -67.9600),
        (-33.2965, -68.3307),
        (-32.8895, -68.8458),
    ],
    "BA_ROSARIO": [
        (-34.6037, -58.3816),
        (-34.0981, -59.0286),
        (-33.3361, -60.2261),
        (-33.0078, -60.5396),
        (-32.9468, -60.6393),
    ],
    "BA_CORDOBA": [
        (-34.6037, -58.3816),
        (-34.0981, -59.0286),
        (-33.8900, -60.5700),
        (-33.7456, -61.9688),
        (-32.6283, -62.6803),
        (-32.0500, -63.4500),
        (-31.4201, -64.1888),
    ],
    "BA_MAR_DEL_PLATA": [
        (-34.6037, -58.3816),
        (-35.5725, -58.0106),
        (-36.3132, -57.6789),
        (-36.8693, -57.7300),
        (-37.3260, -57.7200),
        (-37.6733, -57.5500),
        (-38.0055, -57.5426),
    ],
    "ROSARIO_TUCUMAN": [
        (-32.9468, -60.6393),
        (-31.6107, -60.6973),
        (-30.9500, -60.7700),
        (-29.9069, -61.9517),
        (-29.2311, -63.0136),
        (-27.7834, -64.2642),
        (-27.1200, -65.0400),
        (-26.8083, -65.2176),
    ],
    "URBAN_BA": [
        (-34.6037, -58.3816),
        (-34.5553, -58.4568),
        (-34.4750, -58.5100),
        (-34.4561, -58.5733),
        (-34.5320, -58.5570),
        (-34.6345, -58.4008),
        (-34.6037, -58.3816),
    ],
}

# (route, seq, latitude, longitude) rows, seq counted from 0
ROUTE_POINTS = [
    (route, seq, lat, lon) for route, points in ROUTES.items() for seq, (lat, lon) in enumerate(points)
]

ROUTE_POINT_SCHEMA = StructType(
    [
        StructField("route", StringType()),
        StructField("seq", IntegerType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
    ]
)
