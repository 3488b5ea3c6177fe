"""Schemas of what sources, operators and sinks exchange."""

EVENT = "vehicle_id string, time_ms long, lat double, lon double, event_data map<string,double>"
POINT = "struct<lon:double,lat:double>"
ROAD = f"geom_id string, from_node string, to_node string, fwd_ref string, back_ref string, road_class int, geometry array<{POINT}>"
EDGE = f"ref_id string, geom_id string, is_forward boolean, src string, dst string, road_class int, priority double, max_speed double, length_m double, geometry array<{POINT}>"
#: One flat frame for all that matching gives; kind says which columns are set.
MATCHED = "vehicle_id string, kind string, seq int, time_ms long, ref_id string, start_fraction double, end_fraction double, speed_mps double, seqprob_delta double, lon double, lat double, start_ref string, end_ref string, probability double"
