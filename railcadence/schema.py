"""Column contracts and fixed domain values.

Canonical tables (long form, one row per call of a train at a stop):

stops        stop_seq, stop_id, stop_name, stop_key, lat, lon
passages     mission, mission_type, direction, destination, kind, stop_id, stop_key,
             stop_seq, t, call_pos, origin, n_served, ends_at, observed_at, service_date
missions_ref mission_type, direction, origin, destination, n_stops
headways     mission, direction, stop_key, t, headway_min
gaps         mission, direction, stop_key, gap_min
mission_gaps mission, direction, max_gap_min
scores / gap_stats / drift_stats   observed_at, direction, ...   (append-only histories)
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Missions whose code starts with one of these letters run north.
NORTH_LETTERS = ("E", "I", "J", "O", "Q", "N", "M", "G", "A")
NORTH = "Nord"
SOUTH = "Sud"

# The seven stops a regularity score is kept for, in display order:
# normalised stop name -> short name used in the score columns.
KEY_STOPS = {
    "sceaux": "sceaux",
    "antony": "antony",
    "bourg_la_reine": "bourg_la_reine",
    "chatelet_les_halles": "chatelet",
    "aulnay_sous_bois": "aulnay",
    "aeroport_cdg_1_rer": "cdg1",
    "vert_galant": "vert_galant",
}

# Known feed errors: first letter of the mission type -> true terminus.
DESTINATION_RULES = {
    "K": "Massy - Palaiseau",
    "P": "Saint Rémy-lès-Chevreuse",
    "U": "Laplace",
}

# Score card labels -> short stop name. Two key stops have a score but no card.
CARD_STOPS = {
    "Mitry-Claye": "vert_galant",
    "Saint-Rémy-lès-Ch.": "antony",
    "Aéroport CDG": "cdg1",
    "Tronçon central": "chatelet",
    "Robinson": "sceaux",
}

DUPLICATE_PREFIX = "RATP"      # missions with this prefix repeat another mission
GAP_CAP_MIN = 30               # larger gaps are feed errors
HORIZON_MINUTES = 60           # a score looks at trains due within this time
GREEN_FROM, ORANGE_FROM = 85, 70
MISSING_TEXT = "—"
MISSION_TYPE_LEN = 4

# Snapshot files: columns that are not stop times, and the file prefix per kind.
SNAPSHOT_META = (
    "mission", "type_mission", "destination",
    "gare_depart", "nb_arrets_desservis", "date_observation",
)
SNAPSHOT_PREFIX = {"planned": "horaires_theoriques", "real": "horaires_reels"}

# ------------------------------------------------------------------ struct types
_TEXT_VALUE = T.ArrayType(T.StructType([T.StructField("value", T.StringType())]))

_CALL = T.StructType([
    T.StructField("StopPointRef", T.StructType([T.StructField("value", T.StringType())])),
    T.StructField("AimedDepartureTime", T.StringType()),
    T.StructField("ExpectedDepartureTime", T.StringType()),
])

_JOURNEY = T.StructType([
    T.StructField("VehicleJourneyName", _TEXT_VALUE),
    T.StructField("DestinationName", _TEXT_VALUE),
    T.StructField("EstimatedCalls", T.StructType([
        T.StructField("EstimatedCall", T.ArrayType(_CALL)),
    ])),
])


def _payload(journey: T.StructType) -> T.StructType:
    frame = T.StructType([T.StructField("EstimatedVehicleJourney", T.ArrayType(journey))])
    delivery = T.StructType([T.StructField("EstimatedJourneyVersionFrame", T.ArrayType(frame))])
    return T.StructType([
        T.StructField("Siri", T.StructType([
            T.StructField("ServiceDelivery", T.StructType([
                T.StructField("EstimatedTimetableDelivery", T.ArrayType(delivery)),
            ])),
        ])),
    ])


SIRI_PAYLOAD = _payload(_JOURNEY)

# The calls, by far the largest part of a payload, as the JSON text they are.
SIRI_CALLS = _JOURNEY["EstimatedCalls"].dataType
SIRI_JOURNEY_OF_TEXT = T.StructType([
    T.StructField(f.name, T.StringType() if f.name == "EstimatedCalls" else f.dataType) for f in _JOURNEY
])
SIRI_PAYLOAD_OF_TEXT = _payload(SIRI_JOURNEY_OF_TEXT)

STOP_LIST_CSV = T.StructType([
    T.StructField("geo_point_2d", T.StringType()),
    T.StructField("id_ref_zda", T.IntegerType()),
    T.StructField("nom_zda", T.StringType()),
])

PASSAGES = T.StructType([
    T.StructField("mission", T.StringType()),
    T.StructField("mission_type", T.StringType()),
    T.StructField("direction", T.StringType()),
    T.StructField("destination", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("stop_id", T.IntegerType()),
    T.StructField("stop_key", T.StringType()),
    T.StructField("stop_seq", T.IntegerType()),
    T.StructField("t", T.TimestampType()),
    T.StructField("call_pos", T.IntegerType()),
    T.StructField("origin", T.StringType()),
    T.StructField("n_served", T.IntegerType()),
    T.StructField("ends_at", T.TimestampType()),
    T.StructField("observed_at", T.TimestampType()),
    T.StructField("service_date", T.DateType()),
])

# Rows handed to a front end. All fields may be NULL.
REGULARITY_ROW = T.StructType(
    [T.StructField("date_observation", T.TimestampType()),
     T.StructField("direction", T.StringType())]
    + [T.StructField(f"score_{short}", T.IntegerType()) for short in KEY_STOPS.values()]
)
DRIFT_ROW = T.StructType([
    T.StructField("date_calcul", T.TimestampType()),
    T.StructField("direction", T.StringType()),
    T.StructField("moyenne_allongement", T.DoubleType()),
])
GAPS_ROW = T.StructType([
    T.StructField("date_observation", T.TimestampType()),
    T.StructField("direction", T.StringType()),
    T.StructField("ecart_moyen", T.DoubleType()),
    T.StructField("ecart_median", T.DoubleType()),
    T.StructField("ecart_max", T.DoubleType()),
])
