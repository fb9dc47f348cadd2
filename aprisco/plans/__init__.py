from aprisco.plans.build import Build, BuildFailed, build, refresh
from aprisco.plans.models import MODELS, Model, Warehouse, present

__all__ = ["MODELS", "Build", "BuildFailed", "Model", "Warehouse", "build", "present", "refresh"]
