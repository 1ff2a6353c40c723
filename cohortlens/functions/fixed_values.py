"""Code lists of the school data model.

Fixed values: results are right only with exactly these codes, names and orders.
They are defaults; every function that uses one takes it as an argument.
"""

# Attendance: codes that decide alone, then status x excuse.
DETENTION_CODES = ["DS"]
RESTITUTION_CODES = ["Rcp"]
SUSPENSION_CODES = ["EIS", "EOS", "ESS", "ISS", "SU", "SUS", "Sus", "AE-D", "AE-S"]
ATTENDANCE_STATUSES = {"absence": ["A", "P"], "tardy": ["T"], "early_release": ["E"]}
EXCUSED = ["E", "X"]
UNEXCUSED = ["U"]
UNKNOWN_EXCUSE = ["K"]
ATTENDANCE_CATEGORIES = [
    "detention", "restitution", "suspension",
    "exc_absence", "unexc_absence", "unkn_absence",
    "exc_tardy", "unexc_tardy", "unkn_tardy",
    "exc_early_release", "unexc_early_release", "unkn_early_release",
    "other",
]

# Day-count buckets: label, lowest count, highest count (None = open).
COUNT_BUCKETS = [
    ("_0", 0, 0), ("_1_5", 1, 5), ("_6_10", 6, 10), ("_11_15", 11, 15), ("_gt15", 16, None),
]

# Behaviour resolutions: flag, match kind, text.
RESOLUTIONS = [
    ("expelled", "equals", "Withdraw in lieu of expulsion"),
    ("police", "equals", "Police Referral"),
    ("oss", "contains", "OSS"),
    ("iss", "contains", "ISS"),
    ("leave_school", "equals", "Leave School for Day"),
    ("detention", "contains", "Detention"),
]
RESOLUTION_DEFAULT = "minor_infraction"

# Ordinal grade buckets (1 best ... 5 unknown); everything else is 3.
GRADE_BUCKETS = {
    1: ["A+", "A", "A-", "B+", "B", "B-", "Excelling", "Mastery", "Exceeds Expectations",
        "IB 5", "IB 6", "IB 7", "IB 8"],
    2: ["Pass", "P"],
    4: ["D+", "D", "D-", "F", "Insufficient Progress to Pass", "IB 0", "IB 1", "IB 2", "IB 3",
        "Does Not Meet", "Beginning"],
    5: ["No Credit", "NC", "Not Assessed", "No Evidence", "GW", "I", "W"],
}
GRADE_BUCKET_DEFAULT = 3
GRADE_BUCKET_MISSING = 5

# Letter / point grade families of the count variant; everything else is grades_other.
GRADE_FAMILIES = {
    "A_grades": ["A+", "A", "A-", "7", "6"],
    "B_grades": ["B", "B+", "B-", "5", "4"],
    "C_grades": ["C", "C-", "C+", "3"],
    "D_grades": ["D", "D-", "D+", "2"],
    "F_grades": ["F", "1"],
}
GRADE_FAMILY_DEFAULT = "grades_other"

# Survey grade families.
SURVEY_GRADE_FAMILIES = {
    "A_grades": ["A", "A-"],
    "B_grades": ["B", "B+", "B-"],
    "C_grades": ["C", "C-", "C+"],
    "D_grades": ["D", "D-", "D+"],
    "F_grades": ["F"],
}
SURVEY_UNGRADED = ["NC", "NC-Att", "P"]

# Household relations kept by name.
RELATIONS = [
    "mother", "father", "brother", "sister", "step_father", "step_mother",
    "spouse", "grandparent", "foster_parent",
]

# Federal race / ethnicity codes and home-language codes.
RACE_FLAGS = {
    1: "hispanic", 2: "ai_alaskan_native", 3: "asian", 4: "aa_black",
    5: "native_hawaiian_pi", 6: "white", 7: "multiracial",
}
LANGUAGE_FLAGS = {
    "lang_english": (11, "English"), "lang_spanish": (45, "Spanish"), "lang_somali": (69, "Somali"),
}

# Chosen feature lists.
PU_FEATURES = [
    "exc_absence", "minor_infraction", "psychiatric_disorder_non_depressive", "white", "aa_black",
    "genderf", "lang_english", "age_at_pred_natural", "FR_status", "yrs_enrolled",
    "A_grades", "F_grades",
]
COX_FEATURES = [
    "exc_absence", "lang_english", "genderf", "minor_infraction", "aa_black", "white",
    "age_at_pred_natural", "yrs_enrolled", "FR_status", "A_grades", "F_grades",
    "grades_other",
]
BOARD_FEATURES = [
    "age_at_pred", "grade_bucket1_6mo", "yrs_enrolled", "exc_absence_1_5_6mo",
    "aa_black", "grade_bucket4_6mo", "white", "exc_absence_11_15_6mo", "exc_absence_gt15_6mo",
    "FR_status", "exc_tardy_1_5_6mo", "genderf", "grade_bucket3_6mo", "lang_somali", "sister",
]
