"""Trip analytics and fare estimation on Spark SQL and MLlib."""

from .schema import CODE_PROFILE, REPORT_PROFILE, CleaningProfile, ModelProfile, TuningProfile
from .session import get_session, scratch_path, shared_dir

__all__ = [
    "CODE_PROFILE",
    "REPORT_PROFILE",
    "CleaningProfile",
    "ModelProfile",
    "TuningProfile",
    "get_session",
    "scratch_path",
    "shared_dir",
]
