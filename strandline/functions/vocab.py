"""Small vocabularies of the data model.

Names of people, studies and products are parameters of the transforms, not values here.
Tables become map literals or broadcast frames; none grows with the data.
"""

LOINC = "http://loinc.org"
UCUM = "http://unitsofmeasure.org"
CODING_SYSTEMS = {"loinc": LOINC, "rxNorm": "http://www.nlm.nih.gov/research/umls/rxnorm", "snomedCt": "http://snomed.info/sct"}

DIET_QUESTIONS = {
    "fruitsVegetables": ["92a6518b-61dd-442c-8082-09c3457daada", "bbf31b7d-ea50-45bf-88a9-5c5c21466ce8", "6616bfe1-d22f-488f-8ba6-0695cf19f634"],
    "fat": ["fee4378b-c67a-4bf3-d99f-e94092207ee2", "ff78ee6d-a8ad-4d7b-80e1-2894dca64065", "50a6fdb1-d90c-416a-86a8-bf07602b701c", "ba4c8cee-f422-4a8a-8abc-e4418d8a87d1"],
    "starchyFoods": ["055647aa-77aa-4877-81ae-40a2f08b8c5e", "784f7a2c-6ec8-414b-caa4-b59f1e8a6a1c"],
    "sugar": ["016e5729-7381-455d-b888-38e9e4365fa8", "99e55082-b818-44c7-878b-8da477b300cc", "a39e0c58-32a5-4ace-9980-e42363ae898d", "df1d2dcd-5087-4120-86b1-ca811498c655"],
    "fermentedFoods": ["7d376d7b-4167-49b3-8600-683af1534e77", "e5208b21-21d1-4f88-8c22-0580d4457172", "96ee1662-9b70-4f72-8f48-08ee91252d49"],
    "salt": ["a713aac6-c812-46e7-896c-ab9209d197fc", "ed1856e6-5ba3-4ca2-85d3-1ff744ff492e", "7e2609d6-2b29-4d70-8cbb-69f60d985876", "a7ea3c2f-2f87-4fe3-811e-fe3c85a7c1b1"],
    "alcohol": ["1ce40499-9d9c-4f91-e7c5-da0986503406"],
}
DIET_CATEGORY = {link: category for category, links in DIET_QUESTIONS.items() for link in links}

WHO5_LINKS = [
    "f641ae63-47d5-447e-8dd4-afe1685d4b1f",
    "a07c0c00-3f05-4273-f7fc-ca6a15686efe",
    "76b48a80-9eb9-4a14-8a8d-a09e980d2be3",
    "23c4edfa-fdbe-4884-8d26-173599f7dffb",
    "80c92e40-1223-4cd8-806c-896e0868703f",
]
WHO5_POINTS = {
    "all-of-the-time": 5,
    "most-of-the-time": 4,
    "more-than-half-of-the-time": 3,
    "less-than-half-of-the-time": 2,
    "some-of-the-time": 1,
    "at-no-time": 0,
}
NICOTINE_SCORE = {
    "never-smoked/vaped": 0,
    "quit->5-years-ago": 1,
    "quit-1-5-years-ago": 2,
    "quit-<1-year-ago": 3,
    "light-smoker/vaper-(<10/day)": 4,
    "moderate-smoker/vaper-(10-to-19/day)": 4,
    "heavy-smoker/vaper-(>20/day)": 4,
}
COMORBIDITY = {
    "heartFailure": "Heart failure",
    "pulmonaryArterialHypertension": "Pulmonary arterial hypertension",
    "diabetes": "Diabetes",
    "coronaryArteryDisease": "Coronary artery disease",
    "adultCongenitalHeartDisease": "ACHD (complex)",
    "congenitalHeartDisease2": "ACHD (simple)",
}
STAGE_OF_CHANGE = {
    "a": "Maintenance", "b": "Maintenance", "g": "Maintenance", "h": "Maintenance", "i": "Maintenance",
    "c": "Precontemplation", "d": "Contemplation", "e": "Preparation", "f": "Action",
}
GENDER = {0: "prefer not to state", 1: "male", 2: "female", 3: "trans female", 4: "trans male", 5: "other"}

#: name: (code, unit text); all in UCUM.
UNITS = {
    "mg": ("mg", "mg"), "lbs": ("[lb_av]", "lbs"), "kg": ("kg", "kg"), "bpm": ("/min", "beats/minute"), "mmHg": ("mm[Hg]", "mmHg"),
    "mg_dL": ("mg/dL", "mg/dL"), "mEq_L": ("meq/L", "mEq/L"), "mL_min_173m2": ("mL/min/{1.73_m2}", "mL/min/1.73m2"), "tablet": ("{tbl}", "tbl."),
    "flights": ("flights", "flights"), "count": ("count", "count"), "steps": ("steps", "steps"), "meters": ("m", "meters"),
    "kilometers": ("km", "kilometers"), "miles": ("[mi_i]", "miles"), "m_s": ("m/s", "meters/second"), "cm": ("cm", "centimeters"),
    "percent": ("%", "percent"), "seconds": ("s", "seconds"), "minutes": ("min", "minutes"), "hours": ("h", "hours"),
    "celsius": ("Cel", "celsius"), "fahrenheit": ("[degF]", "fahrenheit"), "mL_kg_min": ("mL/kg/min", "mL/kg/min"),
    "resp_min": ("{Breaths}/min", "breaths/minute"), "mg_dL_glu": ("mg/dL", "mg/dL"), "cm_height": ("cm", "centimeters"),
    "in_height": ("[in_i]", "inches"), "kg_m2": ("kg/m2", "kg/m²"),
}
#: (source, target, operation, factor): mul x*f, div x/f; the two temperatures have operations of their own.
CONVERSIONS = [
    ("lbs", "kg", "mul", 0.45359237), ("kg", "lbs", "div", 0.45359237),
    ("meters", "kilometers", "div", 1000.0), ("kilometers", "meters", "mul", 1000.0),
    ("meters", "miles", "div", 1609.344), ("miles", "meters", "mul", 1609.344),
    ("kilometers", "miles", "div", 1.609344), ("miles", "kilometers", "mul", 1.609344),
    ("seconds", "minutes", "div", 60.0), ("minutes", "seconds", "mul", 60.0),
    ("minutes", "hours", "div", 60.0), ("hours", "minutes", "mul", 60.0),
    ("seconds", "hours", "div", 3600.0), ("hours", "seconds", "mul", 3600.0),
    ("celsius", "fahrenheit", "c2f", 1.0), ("fahrenheit", "celsius", "f2c", 1.0),
    ("cm_height", "in_height", "div", 2.54), ("in_height", "cm_height", "mul", 2.54),
]
#: accessor: (LOINC code, unit name, component code or None)
MEASUREMENTS = {
    "systolicBloodPressure": ("85354-9", "mmHg", "8480-6"), "diastolicBloodPressure": ("85354-9", "mmHg", "8462-4"),
    "bodyWeight": ("29463-7", "kg", None), "creatinine": ("2160-0", "mg_dL", None),
    "estimatedGlomerularFiltrationRate": ("98979-8", "mL_min_173m2", None), "heartRate": ("8867-4", "bpm", None), "potassium": ("6298-4", "mEq_L", None),
    "flightsClimbed": ("93825-7", "flights", None), "stepCount": ("41950-7", "steps", None), "distanceWalkingRunning": ("41951-5", "meters", None),
    "distanceCycling": ("93823-2", "meters", None), "distanceWheelchair": ("93824-0", "meters", None), "distanceSwimming": ("93819-0", "meters", None),
    "walkingSpeed": ("41908-5", "m_s", None), "walkingStepLength": ("93826-5", "cm", None), "walkingAsymmetryPercentage": ("93827-3", "percent", None),
    "walkingDoubleSupportPercentage": ("93828-1", "percent", None), "stairAscentSpeed": ("93829-9", "m_s", None), "stairDescentSpeed": ("93830-7", "m_s", None),
    "walkingSteadiness": ("93831-5", "percent", None), "sixMinuteWalkTestDistance": ("69721-6", "meters", None),
    "appleExerciseTime": ("93833-1", "minutes", None), "appleMoveTime": ("93834-9", "minutes", None), "appleStandTime": ("93835-6", "hours", None),
    "oxygenSaturation": ("2708-6", "percent", None), "bodyTemperature": ("8310-5", "celsius", None), "respiratoryRate": ("9279-1", "resp_min", None),
    "bloodGlucose": ("2339-0", "mg_dL_glu", None), "vo2Max": ("93837-2", "mL_kg_min", None), "restingHeartRate": ("40443-4", "bpm", None),
    "heartRateVariabilitySDNN": ("80404-7", "bpm", None), "walkingHeartRateAverage": ("93840-6", "bpm", None), "height": ("8302-2", "cm_height", None),
    "bodyMassIndex": ("39156-5", "kg_m2", None), "leanBodyMass": ("91557-9", "kg", None), "bodyFatPercentage": ("41982-0", "percent", None),
    "waistCircumference": ("8280-0", "cm", None),
}
ERROR_NAMES = {
    "5": "NOT_FOUND", "not-found": "NOT_FOUND", "6": "ALREADY_EXISTS", "already-exists": "ALREADY_EXISTS", "4": "DEADLINE_EXCEEDED",
    "deadline-exceeded": "DEADLINE_EXCEEDED", "8": "RESOURCE_EXHAUSTED", "resource-exhausted": "RESOURCE_EXHAUSTED", "14": "UNAVAILABLE", "unavailable": "UNAVAILABLE",
}
RETRY_REASONS = ["TRANSIENT_ERROR", "NOT_FOUND"]
COLLECTION_PATTERN = r"^(?:HealthObservations|SensorKitObservations)_[A-Za-z][A-Za-z0-9]*$"
SENSORKIT_PATTERN = r"com\.apple\.SensorKit\.([^_]+)_[A-Fa-f0-9-]+\.json\.zstd$"
HEALTHKIT_PATTERN = r"[A-Za-z]*Identifier[A-Za-z]*"
#: What counts as an address on the waitlist.
EMAIL_PATTERN = r"^(?!\.)(?!.*\.\.)[A-Za-z0-9_'+\-.]*[A-Za-z0-9_+\-]@(?:[A-Za-z0-9][A-Za-z0-9\-]*\.)+[A-Za-z]{2,}$"
#: What is wrong with an item of the deletion queue: the text before and after the value at fault (and the owner).
QUEUE_ERRORS = {
    "owner": ("payload userId '", "' does not match path-derived owner '", "'"),
    "collection": ("collection '", "' is not a permitted collection name"),
    "document": ("invalid documentId '", "'"),
    "retries": ("invalid retryCount '", "'"),
    "reason": ("invalid reason '", "'"),
}
# End of fixed values.
