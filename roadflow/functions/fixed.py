"""Fixed values of the traffic data model: names, domains, bounds and model parameters.

Nothing here is computed; the values are part of the data contract and must stay as they are.
"""

# Event columns in contract order.
EVENT_COLUMNS = [
    "event_id",
    "event_timestamp",
    "area",
    "road_segment_id",
    "road_name",
    "latitude",
    "longitude",
    "vehicle_count",
    "avg_speed_kmph",
    "occupancy_pct",
    "congestion_level",
    "weather",
    "incident_type",
    "incident_duration_minutes",
    "is_weekend",
    "hour_of_day",
    "day_of_week",
    "data_source",
    "generated_at",
    "anomaly_type",
]
OPTIONAL_COLUMNS = [
    "road_name",
    "latitude",
    "longitude",
    "occupancy_pct",
    "weather",
    "incident_duration_minutes",
]
SEGMENT_COLUMNS = [
    "road_segment_id",
    "area_id",
    "area",
    "road_name",
    "latitude",
    "longitude",
    "road_type",
    "lane_count",
    "speed_limit_kmph",
    "capacity_vehicles_per_minute",
    "free_flow_ratio",
    "base_demand_factor",
]
METRIC_COLUMNS = [
    "window_start",
    "window_end",
    "area",
    "road_segment_id",
    "road_name",
    "event_count",
    "avg_vehicle_count",
    "avg_speed_kmph",
    "avg_occupancy_pct",
    "peak_congestion_level",
]
PARTITION_COLUMNS = ["year", "month", "day", "area"]

# Label domains.
AREAS = {
    "WFD": "Whitefield",
    "ECY": "Electronic City",
    "SLB": "Silk Board",
    "ORR": "Outer Ring Road",
    "MTH": "Marathahalli",
    "HBL": "Hebbal",
    "KRM": "Koramangala",
    "IND": "Indiranagar",
    "MGR": "MG Road",
    "YPR": "Yeshwanthpur",
}
AREA_TYPES = {
    "Whitefield": "tech_corridor",
    "Electronic City": "tech_corridor",
    "Silk Board": "major_junction",
    "Outer Ring Road": "tech_corridor",
    "Marathahalli": "major_junction",
    "Hebbal": "major_junction",
    "Koramangala": "residential",
    "Indiranagar": "commercial",
    "MG Road": "commercial",
    "Yeshwanthpur": "residential",
}
WEATHER = ["Clear", "Cloudy", "Rain", "Heavy_Rain"]
INCIDENTS = ["None", "Accident", "Roadwork", "Vehicle_Breakdown", "Road_Closure"]
SCORED_LEVELS = ["Low", "Moderate", "High", "Severe"]  # what the contract and the score use
RANKED_LEVELS = ["Low", "Medium", "High", "Severe"]  # what cleaning, ranking and the marts accept
ANOMALIES = ["None", "Duplicate", "Delayed", "Missing_Field", "Invalid_Value"]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
ROAD_TYPES = ["Highway", "Arterial", "Collector", "Local"]
MISSING_MARKERS = ["Nan", "nan", ""]
DATA_SOURCE = "synthetic_simulator"
UTC_OFFSET = "+05:30"
TIME_ZONE = "Asia/Kolkata"

# Key patterns and coordinate box.
EVENT_ID_PATTERN = "^[A-Z]{3}-[0-9]{3}_[0-9]{8}T[0-9]{6}$"
SEGMENT_ID_PATTERN = "^[A-Z]{3}-[0-9]{3}$"
LATITUDE_BOX = (12.7, 13.2)
LONGITUDE_BOX = (77.4, 77.9)

# Congestion score thresholds, the volume-delay, capacity and occupancy model, recovery after incidents, demand
# factors.
LEVEL_THRESHOLDS = (25.0, 45.0, 65.0)
DELAY_ALPHA = 1.0
DELAY_BETA = 2.5
CAPACITY_DROP = 0.15
VEHICLE_LENGTH_M = 6.5
MIN_MOVING_SPEED = 3.0
MAX_OCCUPANCY = 98.0
MIN_RECOVERY_FLOOR = 0.3
WEATHER_CAPACITY = {"Clear": 1.00, "Cloudy": 0.97, "Rain": 0.85, "Heavy_Rain": 0.70}
WEATHER_SPEED = {"Clear": 1.00, "Cloudy": 0.98, "Rain": 0.88, "Heavy_Rain": 0.72}
ROAD_TYPE_DEMAND = {"Highway": 1.00, "Arterial": 1.00, "Collector": 0.80, "Local": 0.55}
INCIDENT_CAPACITY = {"Accident": 0.45, "Roadwork": 0.60, "Vehicle_Breakdown": 0.70, "Road_Closure": 0.00}
INCIDENT_RECOVERY = {"Accident": 0.50, "Roadwork": 0.25, "Vehicle_Breakdown": 0.30, "Road_Closure": 0.50}
RECOVERY_MINUTES = (10, 60)
DAY_OF_WEEK_DEMAND = {
    "Monday": 1.0,
    "Tuesday": 1.02,
    "Wednesday": 1.02,
    "Thursday": 1.02,
    "Friday": 1.05,
    "Saturday": 1.0,
    "Sunday": 0.9,
}

# Stream settings and fault limits.
WATERMARK = "10 minutes"
WINDOW = "5 minutes"
TOPIC = "traffic-events"
DELAY_FROM_MINUTES = 5
SPEED_CEILING = 100
