"""Fixed values of the motion-data rules. Functions take them as arguments with these defaults."""

# Thresholds of the per-frame rules.
MIN_KP_COUNT, MIN_KP_CONF = 7, 0.6
DEFAULT_KP_COUNT, DEFAULT_KP_CONF = 21, 1.0
MAX_GAP = 30
HAND_WIDTH, EXPRESSION_WIDTH = 45, 100
MAX_CARRY = 5
DEPTH_FLOOR, DEPTH_STDS, DEPTH_FAR = 0.1, 3.0, 2.0
OVERLAP_SHARE, AREA_SHARE = 0.05, 0.01
COVERAGE = {"hands": 0.30, "face": 0.20, "gaze": 0.20}
IK_FAIL, IK_WARN = 0.20, 0.5
HAND_GATE = 0.05
FALLBACK_FPS = 29.97
BBOX_SCALE, ROI_SCALE, ROI_MIN_PX, ROI_DEGENERATE = 1.3, 1.8, 192.0, 16
GAZE_BINS, GAZE_WIDTH, GAZE_OFFSET = 90, 4.0, -180.0
LEFT_EYE, RIGHT_EYE = (362, 385, 387, 263, 373, 380), (33, 160, 158, 133, 153, 144)
HAND_FOCAL, HAND_IMAGE = 5000.0, 256.0
FOCAL_TOLERANCE = 1.0
TORSO_OFFSET, PENETRATION_TOLERANCE = 0.02, 0.005
UTIL_FLOOR, UTIL_SECONDS = 40.0, 5
SMALL_CARD_FRAMES, SMALL_CARD, LARGE_CARD = 12_526, 8, 16
STALE_SECONDS = 86_400
KNUCKLES, TIPS = (1, 4, 7, 10, 13), (3, 6, 9, 12, 15)
# (family, same machine, other machine); the first family that the key contains counts.
TOLERANCES = (("transl", 0.02, 0.06), ("betas", 0.05, 0.2), ("gaze", 0.05, 0.1), ("blink", 0.05, 0.1), ("expression", 0.1, 0.3), ("", 0.02, 0.06))
GOLDEN_AGREEMENT = 0.95
# (prefix of a key, mask): frames where the mask of the golden run doesn't hold aren't compared.
GOLDEN_MASKS = (("left_hand", "left_hand_valid"), ("right_hand", "right_hand_valid"), ("gaze", "gaze_valid"), ("jaw", "face_valid"), ("expression", "face_valid"), ("flame", "face_valid"), ("leye", "face_valid"), ("reye", "face_valid"))
# Joints of the body pose that the arm solver moves, from and to (exclusive); vertices near these joints are arm and hand, or torso.
ARM_JOINTS = (15, 21)
ARM_HAND_JOINTS, TORSO_JOINTS = (18, 19, 20, 21, *range(25, 55)), (*range(10), 12, 13, 14, 15)
ARM_STRIDE, TORSO_STRIDE = 3, 5
SOLVED_SHARE, SOLVED_MEDIAN = 0.2, 0.05
CROP_FRAMES, CROP_POINTS = 40, 100
