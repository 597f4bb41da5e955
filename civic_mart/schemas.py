"""Declared schemas of the mart's tables (Spark DDL).

Types follow the warehouse descriptors: STRING ids and codes, zone-less
DATETIME -> timestamp_ntz, FLOAT -> double, NUMERIC -> decimal(38,9),
INTEGER -> bigint, 0/1 flags as bigint.  REQUIRED columns are listed apart:
Spark does not enforce ``NOT NULL`` on files, ``operators.quality`` does.
"""

from __future__ import annotations

from pyspark.sql import types as T

# fixed values: column names, order and types of the warehouse descriptors
NYC_311_SERVICE_REQUEST = (
    "unique_key string, created_date timestamp_ntz, closed_date timestamp_ntz, complaint_type string, "
    "descriptor string, location_type string, incident_zip string, incident_address string, street_name string, "
    "cross_street_1 string, cross_street_2 string, intersection_street_1 string, intersection_street_2 string, "
    "address_type string, city string, landmark string, facility_type string, status string, due_date timestamp_ntz, "
    "resolution_description string, resolution_action_updated_date timestamp_ntz, community_board string, bbl string, "
    "borough string, x_coordinate_state_plane decimal(38,9), y_coordinate_state_plane decimal(38,9), "
    "open_data_channel_type string, park_facility_name string, park_borough string, latitude double, "
    "longitude double, compute_zip string, compute_borough_boundaries string")
NYC_311_REQUIRED = ["unique_key", "created_date", "complaint_type", "latitude", "longitude"]
# raw API field names that differ from the column names
NYC_311_RENAMES = {"compute_zip": ":@computed_region_efsh_h5xi",
                   "compute_borough_boundaries": ":@computed_region_yeji_bk3q"}

NYC_RESTAURANT_INSPECTION = (
    "camis string, dba string, boro string, building string, street string, zipcode string, phone string, "
    "cuisine_description string, inspection_date timestamp_ntz, action string, violation_code string, "
    "violation_description string, critical_flag string, score decimal(38,9), grade string, grade_date timestamp_ntz, "
    "record_date timestamp_ntz, inspection_type string, latitude double, longitude double, community_board string, "
    "council_district string, census_tract string, bin string, bbl string, nta string")
NYC_INSPECTION_REQUIRED = ["camis", "inspection_date", "violation_code", "record_date", "latitude", "longitude"]

NYC_OPEN_RESTAURANT_APPLICATIONS = (
    "objectid string, globalid string, seating_interest_sidewalk string, restaurant_name string, "
    "legal_business_name string, doing_business_as_dba string, bulding_number string, street string, borough string, "
    "zip string, business_address string, food_service_establishment string, sidewalk_dimensions_length bigint, "
    "sidewalk_dimensions_width bigint, sidewalk_dimensions_area bigint, roadway_dimensions_length bigint, "
    "roadway_dimensions_width bigint, roadway_dimensions_area bigint, approved_for_sidewalk_seating string, "
    "approved_for_roadway_seating string, qualify_alcohol string, sla_serial_number string, sla_license_type string, "
    "landmark_district_or_building string, landmarkdistrict_terms string, healthcompliance_terms string, "
    "time_of_submission timestamp_ntz, latitude double, longitude double, community_board string, "
    "council_district string, census_tract string, bin string, bbl string, nta string")

NYC_2020_NEIGHBORHOOD = (
    "the_geom string, BoroCode string, BoroName string, CountyFIPS string, NTA2020 string, NTAName string, "
    "NTAAbbrev string, NTAType string, CDTA2020 string, CDTAName string, Shape_Leng double, Shape_Area double")
NYC_2020_CENSUS_TRACTS = (
    "the_geom string, CTLabel string, BoroCode string, BoroName string, CT2020 string, BoroCT2020 string, "
    "CDEligibil string, NTAName string, NTA2020 string, CDTA2020 string, CDTANAME string, GEOID string, "
    "Shape_Leng double, Shape_Area double")
NYC_2020_CENSUS_BLOCKS = (
    "the_geom string, CB2020 string, BoroCode string, BoroName string, CT2020 string, BCTCB2020 string, "
    "GEOID string, Shape_Leng double, Shape_Area double")
NYC_2020_POPULATION_BLOCKS = (
    "Year bigint, GeogType string, FIPSCode string, BoroCode string, GeogName string, GeoID string, Pop1 bigint, "
    "Male bigint, Fem bigint, LandAcres double")

FOCUS_COMPLAINT_TYPE = "complaint_type string, complaint_descriptor string, category string"
FOCUS_VIOLATION_CODE = "violation_code string, category string"
LOCATION_CATEGORY = "location_type string, category string"
STAGE_BATCH_EXECUTION = "job_name string, latest_record_date timestamp_ntz, execution_date timestamp_ntz"

STAGE_311_LOCATION = (
    "unique_key string, created_date timestamp_ntz, borough_code string, borough_name string, "
    "neighborhood_code string, neighborhood_name string, zipcode string, tract_bct2020 string, tract_geoid string, "
    "block_bctcb2020 string, block_geoid string, locationType string")

_PLACE = STAGE_311_LOCATION.split("timestamp_ntz, ", 1)[1]
STAGE_INSPECTION_LOCATION = f"camis string, inspection_date timestamp_ntz, {_PLACE}"
STAGE_OPEN_RESTAURANT_LOCATION = f"objectid string, {_PLACE}"
NYC_2020_POPULATION_TRACTS = (
    "Year bigint, GeoType string, Borough string, GeoID string, BCT2020 string, Name string, CDType string, "
    "NTAType string, Pop1 bigint, Male bigint, Fem bigint, LandAcres double")

DIM_COMPLAINT = "ComplaintID string, ComplaintType string, ComplaintDescription string, Category string"
DIM_TIME = "TimeID string, Hour bigint, AMPM string, TimePeriod string"
DIM_DATE = ("DateID string, Year bigint, Month string, DayOfMonth bigint, Week bigint, DayOfWeek string, "
            "IsWeekend bigint")
DIM_LOCATION = ("LocationID string, Borough string, BoroughCode string, Neighborhood string, NeighborhoodCode string, "
                "ZipCode string, Tract string, Block string, LocationType string, PopulationDensity double")
DIM_OPEN_RESTAURANT = "OpenRestaurantID string, OpenRestaurantType string, IsQualifyAlcohol bigint"
DIM_RESTAURANT_VIOLATION = ("RestaurantViolationID string, Cuisine string, ViolationCode string, Category string, "
                            "StartDate timestamp_ntz, EndDate timestamp_ntz, IsCurrent bigint")
FACT_RODENT_ISSUE = ("RodentIssueID string, LocationID string, RestaurantViolationID string, OpenRestaurantID string, "
                     "DateID string, TimeID string, ComplaintID string, NumberOfComplaints bigint, "
                     "NumberOfViolations bigint, AvgResolveTimeForComplaints double")


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def all_strings(ddl: str, renames: dict[str, str] | None = None) -> T.StructType:
    """The raw form of a table: every field a string, under its source name."""
    renames = renames or {}
    return T.StructType([T.StructField(renames.get(f.name, f.name), T.StringType()) for f in struct(ddl).fields])
