"""Texts that appear in results exactly as given."""

FIRE = "Risk of fire! "
FREEZING = "Freezing Alarm for"
LATE = "*** late reading ***"
RISING_BEFORE_ID = "Temperature of sensor '"
RISING_AFTER_ID = "' monotonically increased for 1 second."
UNKNOWN_ROOM = "UNKNOWN ROOM"
FIRST_RESULT, UPDATED_RESULT = "first", "update"
