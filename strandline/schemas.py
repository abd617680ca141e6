"""Schemas of the logical tables, as DDL."""

USERS = (
    "user_id string, disabled boolean, hasWithdrawnFromStudy boolean, mostRecentOnboardingStep string, participantGroup int, didOptInToTrial boolean, "
    "triggerNudgeGeneration boolean, extendedActivityNudgesOptIn boolean, posttrialWelcomeNudgeScheduled boolean, timeZone string, preferredNotificationTime string, "
    "userLanguage string, language string, dateOfBirth timestamp, dateOfEnrollment timestamp, lastActiveDate timestamp, lastUploadDate timestamp, "
    "comorbidities map<string,string>, stageOfChange string, educationUS string, educationUK string, genderIdentity string, genderCode int, "
    "preferredWorkoutTypes string, fcmToken string, toBeDeleted boolean, deletionRequest struct<requestedAt:timestamp,requestedBy:string,status:string>, "
    "studyEnrollmentHistory array<struct<action:string,timestamp:timestamp,requestedBy:string>>"
)
CODING = "struct<system:string,version:string,code:string,display:string>"
CONCEPT = f"struct<coding:array<{CODING}>,text:string>"
QUANTITY = "struct<code:string,system:string,unit:string,value:double>"
OBSERVATIONS = (
    "user_id string, collection string, id string, status string, subject struct<reference:string,type:string,display:string,identifier:string>, "
    f"code {CONCEPT}, valueQuantity {QUANTITY}, component array<struct<code:{CONCEPT},valueQuantity:{QUANTITY}>>, effectiveDateTime timestamp, "
    "effectiveInstant timestamp, effectivePeriod struct<start:timestamp,end:timestamp>, issued timestamp, derivedFrom array<struct<reference:string>>, "
    "extension array<struct<url:string,valueString:string>>"
)
BACKLOG = (
    "user_id string, id string, title string, body string, timestamp timestamp, category string, isLLMGenerated boolean, generatedAt timestamp, llmPrompt string, "
    "llmPromptVersion string, llmModel string, llmTokenUsage struct<promptTokens:int,completionTokens:int,totalTokens:int>"
)
HISTORY = (
    "user_id string, id string, title string, body string, originalTimestamp timestamp, processedTimestamp timestamp, status string, errorMessage string, "
    "category string, isLLMGenerated boolean, generatedAt timestamp"
)
RESPONSES = "user_id string, id string, questionnaire string, authored timestamp, item_json string"
ANSWERS = (
    "user_id string, response_id string, link_id string, path array<string>, ordinal int, is_leaf boolean, code string, value_boolean boolean, value_integer double, "
    "value_decimal double, value_string string, value_quantity double"
)
PENDING_DELETIONS = (
    "user_id string, doc_path string, userId string, collection string, documentId string, jobId string, requestingUserId string, reason string, lastError string, "
    "retryCount int, createdAt timestamp, nextRetryAt timestamp"
)
VERSIONS = "user_id string, t timestamp, seq bigint, content_json string, source_updated_at timestamp, deleted boolean"
CHANGES = "path string, before_json string, after_json string, event_time timestamp"
WAITLIST = "region string, email string, createdAt timestamp"
DEVICES = "user_id string, id string, notificationToken string, platform string, osVersion string, appVersion string, appBuild string, language string, timeZone string"
MESSAGES = (
    "user_id string, id string, creationDate timestamp, dueDate timestamp, completionDate timestamp, type string, title map<string,string>, "
    "description map<string,string>, action string, isDismissible boolean, reference string"
)
AUTH_USERS = "uid string, displayName string, email string, phoneNumber string, photoURL string, customClaims map<string,string>, lastSignInTime timestamp"
