"""Fixed values of the filing format.

Everything in this file is a value the receiving side prescribes (codes,
widths, tokens, category names).  It is stated as plain text tables; no logic.
"""

# --- Fixed values: line layout -------------------------------------------
LINE_WIDTH = 160
PREFIX_WIDTH = 12
LINE_MARK = "******"
JURISDICTION_WIDTH = 6
FEDERAL = "F"
TRAILER_MARK = "999999999999"
COMPANY_SUFFIX = "10000NN             Y"

# --- Fixed values: worker fields (field | code | format | width | level) ---
WORKER_FIELDS = """
given_name                      CS text    12 EE
family_name                     CU text    14 EE
ssn                             DD text     0 EE
birth_date                      SY date    10 EE
hire_date                       NZ date    10 EE
termination_date                PF date    10 EE
gender                          EG text     1 EE
retirement_plan_indicator       DZ text     1 EE
third_party_sick_pay_indicator  B2 text     1 EE
replacement_worker              8R text     1 EE
pull_indicator                  G6 text     1 F
print_suppress_flag             G5 text     1 F
corporate_officer_indicator     ED text     1 S
department_code                 G4 text     6 F
independent_contractor          32 text     1 EE
middle_name                     CT text     1 EE
seasonal_employee               EF text     1 S
seasonal_employee_local         85 text     1 L
medical_coverage_indicator      EC text     1 S
wfh_indicator                   9F text     1 L
ee_post_indicator               Q9 text     1 F
work_postal_code                JZ text     9 S
employee_id                     V9 text    10 F
job_title                       Z3 text    80 S
remuneration_basis              A8 text     1 EE
family_status                   QG text     1 S
statutory_flag                  EE text     1 EE
pay_rate_amount                 A7 decimal 10 S
"""

# --- Fixed values: address fields (column | code | width) -----------------
ADDRESS_FIELDS = """
work_line_one    SQ 30
home_line_one    Z5 40
work_city_name   CY 18
home_city_name   Z7 30
work_state_code  DA  2
home_state_code  Z8  2
work_postal_code DB  9
home_postal_code Z9  9
"""

# --- Fixed values: special layouts per code -------------------------------
IDENTITY_NUMBER_CODE = "DD"
OVERFLOW_CODES = {"CS": ("A1", 12), "CU": ("A2", 14)}
YEAR_FIRST_DATE_CODE = "SY"
PAY_RATE_DECIMALS = 4

# --- Fixed values: tax cells
#     (measure | tax type | code | width | decimals | signed | mandatory) ----
TAX_CELLS = """
qtd_amount           FIT      EJ 12 2 Y N
qtd_amount           SSEE-QTD 7H 12 2 Y Y
ytd_amount           FIT      EK 14 2 Y N
ytd_amount           SSEE     5H 14 2 Y Y
ytd_amount           MEDEE    5E 14 2 Y Y
qtd_gross_wages      SIT      MV 12 2 Y N
ytd_gross_wages      SIT      NT 12 2 Y N
qtd_amount_count     COBRA-CR V7  7 0 N N
ytd_amount_count     COBRA-CR V8  7 0 N N
filing_status        FIT      DF  1 0 N N
filing_status        SIT      DH  1 0 N N
filing_status        CIT      DK  1 0 N N
number_of_allowances FIT      DG  2 0 N N
number_of_allowances SIT      DI  2 0 N N
number_of_allowances CIT      DL  2 0 N N
sdi_exempt_flag      SDIEE    EB  1 0 N N
sui_exempt_flag      SUIER    EA  1 0 N N
"""

MANDATORY_CODES = ("7H", "5E")

# --- Fixed values: employee / employer tax type pairs ----------------------
TAX_PAIRS = """
SocialSecurity SSEE   SSER
MEDICARE       MEDEE  MEDER
SUI            SUIEE  SUIER
SDI            SDIEE  SDIER
FICA           FICAEE FICAER
"""

# --- Fixed values: slots of a tax row, in output order
#     (slot measure | kind | default width | decimals) -----------------------
TAX_SLOTS = """
lived_in_code           place   6 0
qtd_amount              amount 12 2
qtd_taxable_amount      amount 12 2
qtd_subject_amount      amount 12 2
qtd_gross_wages         amount 12 2
ytd_amount              amount 14 2
ytd_taxable_amount      amount 14 2
ytd_subject_amount      amount 14 2
ytd_gross_wages         amount 14 2
tax_rate                amount  8 4
hours_worked            amount  8 0
qtd_overtime_amount     amount 14 2
ytd_overtime_amount     amount 14 2
oos_qtd_gross_wages     amount 14 2
oos_ytd_gross_wages     amount 14 2
oos_qtd_taxable_amount  amount 14 2
oos_ytd_taxable_amount  amount 14 2
qtd_amount_count        amount  7 0
ytd_amount_count        amount  7 0
filing_status           text    1 0
number_of_allowances    count   2 0
sui_exempt_flag         text    1 0
sdi_exempt_flag         text    1 0
"""
LIVED_IN_CODE = "X1"

# --- Fixed values: feed token -> measure ----------------------------------
TOKENS = """
QTDT                       qtd_amount
YTDT                       ytd_amount
QTDTAXW                    qtd_taxable_amount
YTDTAXW                    ytd_taxable_amount
QTDW                       qtd_taxable_amount
YTDW                       ytd_taxable_amount
QTDSUBJW                   qtd_subject_amount
YTDSUBJW                   ytd_subject_amount
QTDG                       qtd_gross_wages
YTDG                       ytd_gross_wages
QTD-EXEMPT-OVERTIME-INCOME qtd_overtime_amount
YTD-EXEMPT-OVERTIME-INCOME ytd_overtime_amount
QTDG-OOS                   oos_qtd_gross_wages
YTDG-OOS                   oos_ytd_gross_wages
QTDTAXW-OOS                oos_qtd_taxable_amount
YTDTAXW-OOS                oos_ytd_taxable_amount
QTD-HOUR-WORK              hours_worked
YTD-HOUR-WORK              hours_worked
QTD-QUALIFY-CNT            qtd_amount_count
YTD-QUALIFY-CNT            ytd_amount_count
CD-MARITAL-STS             filing_status
CD-2-BYTE-EXEMPT           number_of_allowances
CD-SDIEE-EXEMPT            sdi_exempt_flag
CD-SUIER-EXEMPT            sui_exempt_flag
CD-PSD                     lived_in_code
"""

# --- Fixed values: record code of a level row -> level ---------------------
LEVEL_RECORDS = {"EEF": "F", "EES": "S", "EEL": "L"}
LEVEL_FILE_CODE = "Q"

# --- Fixed values: out-of-state JSON keys (column | key) --------------------
OUT_OF_STATE_KEYS = {
    "oos_qtd_gross_wages": "qtdGrossWages",
    "oos_ytd_gross_wages": "ytdGrossWages",
    "oos_qtd_taxable_amount": "qtdTaxableAmount",
    "oos_ytd_taxable_amount": "ytdTaxableAmount",
}

# --- Fixed values: file status ---------------------------------------------
FILE_STATUSES = (
    "QUEUED", "GENERATING", "GENERATED", "FAILED_GENERATION", "IGNORED", "SKIPPED", "FAILED",
)
QUEUE_FILE_TYPE = "QUARTER"

# --- Fixed values: error category -> area, scope, rationale ------------------
CATEGORY_CLASSES = (
    ("COMPANY", "PERIODIC", "COMPANY",
     "A company error concerns deposits, so it belongs to periodic work."),
    ("WORKER_PROFILE", "QUARTER", "WORKER",
     "A worker profile error shows in the quarterly file."),
    ("PAYROLL", "QUARTER", "WORKER",
     "A payroll or tax error shows in the quarterly file."),
    ("PAYROLL_AND_TAX", "QUARTER", "WORKER",
     "A payroll or tax error shows in the quarterly file."),
    ("PAYROLL_TAX", "QUARTER", "WORKER",
     "A payroll or tax error shows in the quarterly file."),
)
UNCLASSIFIED_RATIONALE = "Nothing assigns this category to an area."
TRUE_WORDS = ("true", "t", "1", "y", "yes")

# --- Fixed values: error catalog
#     (error_code | legacy | type | category | impacts deposit | impacts filing)
ERROR_CATALOG = """
SSN_NON_NUM                   73  SSN           WORKER_PROFILE N N
SSN_F3_0                      73  SSN           WORKER_PROFILE N N
SSN_F3_6                      73  SSN           WORKER_PROFILE N N
SSN_M2_0                      73  SSN           WORKER_PROFILE N N
SSN_L4_0                      73  SSN           WORKER_PROFILE N N
SSN_EQ_NUM                    73  SSN           WORKER_PROFILE N N
SSN_REV_SEQ                   73  SSN           WORKER_PROFILE N N
SSN_SEQ                       73  SSN           WORKER_PROFILE N N
SSN_F1_9                      73  SSN           WORKER_PROFILE N N
FEIN_NOT_CORRECT              57  TAX           COMPANY        N N
PAY_FREQ_MIS                  307 TAX           COMPANY        N N
PAY_FREQ_INV                  308 TAX           COMPANY        N N
EMP_CNT_MIS                   309 TAX           COMPANY        N N
YD_FIT_TAX_MIS                10  WORKER_TAX    PAYROLL        N N
SUI_SUBWG_LT_TAXWG            30  WORKER_TAX    PAYROLL        N N
SUI_TAXWG_LT_SUBWG            31  WORKER_TAX    PAYROLL        N N
YD_MED_TAX_WG_NE              41  WORKER_TAX    PAYROLL        N N
YD_EMP_MED_TAX_NG             43  WORKER_TAX    PAYROLL        N N
YD_FIT_WG_MIS                 08  WORKER_TAX    PAYROLL        N N
YD_SIT_WG_MIS                 12  TAX           PAYROLL        N N
QD_CA_VPDI_SDI_NE_SUI_WG      CA  TAX           PAYROLL        N N
WV_SUI_CNTY_WRKD_MIS          CN  TAX           PAYROLL        N N
NJ_FLI_QD_SUBJ_GT_YD          F1  TAX           PAYROLL        N N
NJ_FLI_QD_SUBJ_LT_YD          F2  TAX           PAYROLL        N N
BIRTH_DT_MIS                  53  W2_REPORTING  PAYROLL        N N
BIRTH_DT_OOR                  56  W2_REPORTING  PAYROLL        N N
EXE_SAL_EXC_E                 57  W2_REPORTING  PAYROLL        N N
RET_FUND_CODA_GT_0            54  W2_REPORTING  PAYROLL        N N
DE_PFML_WG_HRS_MIS            D3  TAX           PAYROLL        N N
DE_PFML_WG_WKS_MIS            D4  TAX           PAYROLL        N N
DE_PFML_QTD_WKS_GT_14         D5  TAX           PAYROLL        N N
DE_PFML_YTD_WKS_GT_53         D6  TAX           PAYROLL        N N
DE_PFML_HRS_GT_2200           D7  TAX           PAYROLL        N N
QD_MED_TAX_WG_NE              40  WORKER_TAX    WORKER_PROFILE N N
YD_MED_WG_LT_SSAE_OR_TIPS     49  WORKER_TAX    PAYROLL        N N
QD_FIT_WG_MIS                 07  WORKER_TAX    PAYROLL        N N
YD_SSAE_WG_MIS                08  WORKER_TAX    PAYROLL        N N
SSAE_WG_MIS                   09  WORKER_TAX    PAYROLL        N N
DE_PFML_ER_CNTRB_PCT_OOR      D1  TAX           PAYROLL        N N
QD_EMP_MED_TAX_NEG            42  WORKER_TAX    WORKER_PROFILE N N
E002                          02  SSN           Validation     N Y
E001                          01  CAWagePlan    WagePlan       Y Y
CA_WAGE_PLAN_MISSING          E01 CA_WAGE_PLAN  WagePlan       N Y
FEIN_IS_MISSING               E02 TAX_ID        Registration   N Y
SUI_RATE_INVALID              E03 UNEMP_INS     WagePlan       N N
FL_REEMPLOY_CODE              E04 REEMPLOY_ASST WagePlan       N N
MW_ID_MIS                     29  TAX           COMPANY        N N
SUIER_TX_RT_MIS               RM  WORKER_TAX    COMPANY        N N
TOS_0_TX_WG_GT_0              TS  TAX           COMPANY        N N
WG_GT_0_HRS_0_NO_RSN          ZH  TAX           COMPANY        N N
YD_COBRA_MED_NEG              9P  WORKER_TAX    PAYROLL        N N
QD_SDIE_LT_SUI_TXWG           9S  WORKER_TAX    PAYROLL        N N
QD_FIT_TXWH_NE_0              9T  WORKER_TAX    PAYROLL        N N
MA_FLI_EE_PCT_OOR             FL  TAX           PAYROLL        N N
MA_PML_EE_PCT_OOR             FL  TAX           PAYROLL        N N
SUI_PLAN_MIS                  22  WORKER_TAX    PAYROLL        N N
HLT_INS_IND_INV               14  WORKER_TAX    PAYROLL        N N
LIV_PSD_MIS                   27  WORKER_TAX    PAYROLL        N N
PRT_IND_INV                   13  WORKER_TAX    PAYROLL        N N
WC_INF_MIS                    WC  TAX           COMPANY        N N
SDIR_TX_WG_NE_SDIE            NJ  TAX           COMPANY        N N
FI_TAX_CR                     922 SERVICE_LEVEL COMPANY        N N
FUTA_CR                       923 SERVICE_LEVEL COMPANY        N N
SIT_CR                        924 SERVICE_LEVEL COMPANY        N N
SUIEE_CR                      925 SERVICE_LEVEL COMPANY        N N
SUIER_CR                      926 SERVICE_LEVEL COMPANY        N N
SDIEE_CR                      927 SERVICE_LEVEL COMPANY        N N
SDIER_CR                      928 SERVICE_LEVEL COMPANY        N N
CIT_CR                        929 SERVICE_LEVEL COMPANY        N N
SIT_CIT_TXWH_GT_FIT_TX_WG     N1  WORKER_TAX    EMPLOYEE       N N
WG_PLN_MIS                    15  WORKER_TAX    PAYROLL        N N
WG_DIFF_NEQ                   19  WORKER_TAX    PAYROLL        N N
PR_INV_PART_TIME_EE           34  WORKER_TAX    PAYROLL        N N
PA_PSD_510101_LOC_NE_3901_3912 44 WORKER_TAX    PAYROLL        N N
SC_SUI_WG_GT_0_HRS_LE_0       H1  WORKER_TAX    PAYROLL        N N
SC_SUI_WG_GT_0_HRS_MIS        H2  WORKER_TAX    PAYROLL        N N
WV_SUI_INV_CNTY_WRKD          IC  WORKER_TAX    PAYROLL        N N
WV_SUI_JOB_TTL_SOC_MIS        J4  WORKER_TAX    PAYROLL        N N
WV_SUI_JOB_TTL_SPCL_CHR       JN  WORKER_TAX    PAYROLL        N N
SC_SUI_SOC_CODE_MIS           JS  WORKER_TAX    PAYROLL        N N
MA_MLI_EE_PCT_OOR             ML  TAX           PAYROLL        N N
"""

# --- Fixed values: skip scopes, broadest first ------------------------------
SKIP_SCOPES = (
    "SKIP_COMPANY_OUTPUT",
    "SKIP_COMPANY_TAX_OUTPUT",
    "SKIP_ENTIRE_EMPLOYEE",
    "SKIP_ALL_TAX_FOR_EMPLOYEE",
    "SKIP_TAX_JURISDICTION",
    "SKIP_REPORTING_CODES",
    "SKIP_NON_REPORTING_CODES",
    "SKIP_CODE",
    "NO_SKIP",
)


def table(text: str) -> list[list[str]]:
    """Rows of a whitespace-separated text table."""
    return [line.split() for line in text.strip().splitlines()]
