"""The three criteria with their cut-offs."""

from __future__ import annotations

from daymark.functions.scoring import Band, Criterion, Score

# --- Fixed values: clinical cut-offs and points ------------------------------

PT_CONTROL_SECONDS = 12.0

PLATELETS = (Band("<", 50, 2), Band("<", 100, 1))
INR = (Band(">", 1.4, 2), Band(">=", 1.2, 1))
SOFA = (Band(">=", 2, 1),)
PT_PROLONGATION = (Band(">=", 6, 2), Band(">=", 3, 1))
FIBRINOGEN = (Band("<", 100, 1),)
D_DIMER = (Band(">", 5000, 3), Band(">=", 500, 2))

HEART_RATE = (Band(">", 90, 1),)
RESP_RATE = (Band(">", 20, 1),)
TEMPERATURE = (Band("<", 36, 1), Band(">", 38, 1))
WHITE_CELLS_PER_UL = (Band("<", 4000, 1), Band(">", 12000, 1))
JAAM_PLATELETS = (Band("<", 80, 3), Band("<", 120, 1))
JAAM_INR = (Band(">=", 1.2, 1),)

SIC_CUT = 4
ISTH_CUT = 5
JAAM_CUT = 4

# -----------------------------------------------------------------------------


def sic(cut: int = SIC_CUT) -> Criterion:
    """Sepsis-induced coagulopathy."""
    return Criterion(
        name="sic",
        scores=(
            Score("platelet_score", "platelet_avg", PLATELETS),
            Score("inr_score", "inr_avg", INR),
            Score("sofa_indicator", "average_sofa_score", SOFA),
        ),
        cut=cut,
        today="sic_today",
        tomorrow="sic_tomorrow",
        onset="sic_next_day",
    )


def isth(cut: int = ISTH_CUT, pt_control: float = PT_CONTROL_SECONDS) -> Criterion:
    """Overt disseminated intravascular coagulation, ISTH scoring."""
    return Criterion(
        name="isth",
        scores=(
            Score("dic_platelet_score", "platelet_avg", PLATELETS),
            Score("dic_pt_score", "pt_avg", PT_PROLONGATION, control=pt_control),
            Score("dic_fibrinogen_score", "fibrinogen_avg", FIBRINOGEN),
            Score("dic_d_dimer_score", "d_dimer_avg", D_DIMER),
        ),
        total="dic_score",
        cut=cut,
        today="dic_today",
        tomorrow="dic_tomorrow",
        onset="dic_next_day",
    )


def sirs(white_cell_unit: float = 1.0) -> tuple[Score, ...]:
    """The four SIRS signs; an unmeasured sign counts as absent.

    ``white_cell_unit`` is the number of cells per microlitre that one unit of
    ``wbc_avg`` stands for: 1 by default, 1000 for counts in thousands.
    """
    return (
        Score("sirs_hr", "mean_heart_rate", HEART_RATE, missing=0),
        Score("sirs_rr", "mean_resp_rate", RESP_RATE, missing=0),
        Score("sirs_temp", "max_temperature", TEMPERATURE, missing=0),
        Score("sirs_wbc", "wbc_avg", WHITE_CELLS_PER_UL, missing=0).rescaled(1 / white_cell_unit),
    )


def jaam(cut: int = JAAM_CUT, white_cell_unit: float = 1.0) -> Criterion:
    """Disseminated intravascular coagulation, modified JAAM scoring."""
    return Criterion(
        name="jaam",
        parts=(("sirs_score", sirs(white_cell_unit)),),
        scores=(
            Score("jaam_platelet_score", "platelet_avg", JAAM_PLATELETS),
            Score("jaam_inr_score", "inr_avg", JAAM_INR),
        ),
        total="jaam_score",
        cut=cut,
        today="jaam_dic_today",
        tomorrow="jaam_dic_tomorrow",
        onset="jaam_dic_progression",
    )


SIC = sic()
ISTH = isth()
JAAM = jaam()
