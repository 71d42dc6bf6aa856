"""Table builds: raw load, the 14 OMOP-like tables, integrity checks."""

from carelake.plans.condition import build_condition_dcir, build_condition_pmsi
from carelake.plans.device import build_device_dcir, build_device_pmsi
from carelake.plans.drug import build_drug_dcir, build_drug_pmsi
from carelake.plans.measurement import build_measurement_dcir, build_measurement_pmsi
from carelake.plans.medical_units import build_medical_units
from carelake.plans.person import build_causes_of_death, build_person
from carelake.plans.prestations import build_prestations
from carelake.plans.procedure import build_procedure
from carelake.plans.stays import build_stays

__all__ = [
    "build_causes_of_death", "build_condition_dcir", "build_condition_pmsi",
    "build_device_dcir", "build_device_pmsi", "build_drug_dcir", "build_drug_pmsi",
    "build_measurement_dcir", "build_measurement_pmsi", "build_medical_units",
    "build_person", "build_prestations", "build_procedure", "build_stays",
]
