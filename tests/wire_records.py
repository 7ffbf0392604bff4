"""Wire records for tests."""


def event(**changes):
    """A valid wire record."""
    record = {
        "event_id": "WFD-001_20260701T081500",
        "event_timestamp": "2026-07-01T08:15:00+05:30",
        "area": "Whitefield",
        "road_segment_id": "WFD-001",
        "road_name": "Main Road",
        "latitude": 12.97,
        "longitude": 77.75,
        "vehicle_count": 10,
        "avg_speed_kmph": 30.5,
        "occupancy_pct": 12.5,
        "congestion_level": "Low",
        "weather": "Clear",
        "incident_type": "None",
        "incident_duration_minutes": 0,
        "is_weekend": False,
        "hour_of_day": 8,
        "day_of_week": "Wednesday",
        "data_source": "synthetic_simulator",
        "generated_at": "2026-07-01T08:16:01.500+05:30",
        "anomaly_type": "None",
    }
    return record | changes
