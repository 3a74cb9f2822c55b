"""The catalog of question templates, as data.

A template is a row: which subjects (by type and a date), which property gives
the answer, and how the question reads. All of them are evaluated by the same
plan, so a new template is a new row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factspark import schemas
from factspark.fixed import STYLES

# The templates, by their status, in their order. Columns: domain, topic, type of answer, family of questions,
# type of subject (id, label), date property, target property (id, label), question; then what differs from the defaults.
TEMPLATES = """
[active]
film_director | Arts and Media | Person | who_directed_film | Q11424 | film | P577 | P57 | director | Who directed the {subject_kind} {descriptor}?
novel_author | Language and Literature | Person | who_wrote_novel | Q8261 | novel | P577 | P50 | author | Who wrote the {subject_kind} {descriptor}?
book_original_language | Language and Literature | Language | what_language_originally_written | Q571 | book | P577 | P364 | original language of work | What language was the {subject_kind} {descriptor} originally written in?
video_game_developer | Computer Science and AI | Organization | which_company_developed_video_game | Q7889 | video game | P577 | P178 | developer | Which company developed the {subject_kind} {descriptor}?
software_developer | Computer Science and AI | Organization | which_company_developed_software | Q7397 | software | P577 | P178 | developer | Which company developed the {subject_kind} {descriptor}? | exact
scholarly_article_journal | Physical Sciences | Organization | which_journal_published_article | Q13442814 | scholarly article | P577 | P1433 | published in | In which journal was the {subject_kind} {descriptor} published?
artwork_creator | Arts and Media | Person | who_created_artwork | Q838948 | artwork | P571 | P170 | creator | Who created the {subject_kind} {descriptor}? | exact
album_performer | Arts and Media | Person | which_artist_released_album | Q482994 | album | P577 | P175 | performer | Which artist released the {subject_kind} {descriptor}?
building_architect | Architecture and Transportation | Person | who_designed_building | Q41176 | building | P571 | P84 | architect | Who designed the {subject_kind} {descriptor}? | exact
rail_station_country | Architecture and Transportation | Place | which_country_station_located | Q55488 | railway station | P571 | P17 | country | In which country is the {subject_kind} {descriptor} located? | exact
museum_country | Society and Culture | Place | which_country_museum_located | Q33506 | museum | P571 | P17 | country | In which country is the {subject_kind} {descriptor} located? | exact
company_founder | Economy and Business | Person | who_founded_company | Q783794 | company | P571 | P112 | founder | Who founded the {subject_kind} {descriptor}? | exact
[multi_hop_pilot]
ordinal_tournament_winner | Sports and Recreation | Entity | who_won_ordinal_tournament | Q132241 | tournament edition | P585 | P1346 | winner | Who won the {ordinal} edition of {descriptor}? | style=ordinal_fact; mode=time_related_join; clues=edition; surface=false; slot=subject; hop=1
person_first_degree_university | People | Organization | which_university_first_degree | Q5 | human | P69 | P69 | educated at | From which university did {descriptor} receive a first degree? | style=fact_join; mode=time_related_join; clues=first degree; surface=false; slot=relation; hop=1
film_source_work_author | Arts and Media | Person | who_wrote_source_work_for_film | Q11424 | film | P577 | P50 | author | Who wrote the work that the film {descriptor} was based on? | style=fact_join; mode=time_related_join; clues=based on; surface=false; slot=subject; hop=1
[date_answer_pilot]
benchmark_release_date | Computer Science and AI | Date | when_benchmark_released | Q1172284 | dataset | P577 | P577 | publication date | On what day, month, and year was the benchmark {descriptor} released? | exact; format=date; granularity=day; mode=date_answer
product_release_date | Engineering and Technology | Date | when_product_released | Q2424752 | product | P577 | P577 | publication date | On what day, month, and year was the product {descriptor} released? | exact; format=date; granularity=day; mode=date_answer
terminal_opening_date | Architecture and Transportation | Date | when_terminal_opened | Q55488 | terminal | P571 | P571 | inception | On what day, month, and year did the terminal {descriptor} open? | exact; format=date; granularity=day; mode=date_answer
[blueprint]
wedding_age_gap | People | Number | what_age_gap_couple | Q27020041 | wedding | P585 | P1534 | end cause | What was the age gap between the couple in {descriptor}? | format=number; style=fact_join
marriage_spouse | People | Person | who_married_person | Q171318 | marriage | P580 | P26 | spouse | Who married {descriptor}? | style=fact_join
biography_birth_place_recent_subject | People | Place | where_person_born | Q5 | human | P569 | P19 | place of birth | Where was {descriptor} born?
biography_native_language_recent_subject | People | Language | what_native_language_person | Q5 | human | P569 | P103 | native language | What is the native language of {descriptor}?
person_first_degree_university | People | Organization | which_university_first_degree | Q5 | human | P69 | P69 | educated at | From which university did {descriptor} receive a degree? | style=fact_join; mode=time_related_join; slot=relation; hop=1
new_park_country | Geography | Place | which_country_park_located | Q22698 | park | P571 | P17 | country | In which country is the park {descriptor} located?
new_metro_station_country | Geography | Place | which_country_station_located | Q928830 | metro station | P571 | P17 | country | In which country is the metro station {descriptor} located?
new_bridge_crosses | Geography | Place | what_body_of_water_bridge_crosses | Q12280 | bridge | P571 | P177 | crosses | What body of water does the bridge {descriptor} cross?
new_airport_serves_city | Geography | Place | which_city_airport_serves | Q1248784 | airport | P571 | P131 | located in administrative territorial entity | Which city includes the airport {descriptor}?
new_trail_country | Geography | Place | which_country_trail_located | Q179049 | trail | P571 | P17 | country | In which country is the trail {descriptor} located?
law_jurisdiction | Politics and Law | Place | which_jurisdiction_law | Q7748 | law | P577 | P1001 | applies to jurisdiction | In which jurisdiction does the law {descriptor} apply?
law_legislature | Politics and Law | Organization | which_legislature_passed_law | Q7748 | law | P577 | P467 | legislated by | Which legislature enacted the law {descriptor}?
treaty_signatory_country | Politics and Law | Place | which_country_signed_treaty | Q131569 | treaty | P577 | P17 | country | Which country is associated with the treaty {descriptor}?
court_case_court | Politics and Law | Organization | which_court_decided_case | Q2334719 | legal case | P585 | P1591 | defendant | Which court decided the case {descriptor}?
policy_department | Politics and Law | Organization | which_department_issued_policy | Q49884 | government policy | P577 | P749 | parent organization | Which department issued the policy {descriptor}?
startup_founder | Economy and Business | Person | who_founded_startup | Q4830453 | business | P571 | P112 | founder | Who founded the startup {descriptor}?
company_founded_country | Economy and Business | Place | which_country_company_founded | Q783794 | company | P571 | P495 | country of origin | In which country was the company {descriptor} founded?
product_manufacturer | Economy and Business | Organization | which_company_manufactured_product | Q2424752 | product | P577 | P176 | manufacturer | Which company manufactured the product {descriptor}?
exchange_operator | Economy and Business | Organization | which_company_operates_exchange | Q11654 | stock exchange | P571 | P137 | operator | Which company operates the exchange {descriptor}?
festival_host_city | Society and Culture | Place | which_city_hosts_festival | Q132241 | festival | P585 | P131 | located in administrative territorial entity | Which city hosted {descriptor}?
museum_founder | Society and Culture | Person | who_founded_museum | Q33506 | museum | P571 | P112 | founder | Who founded the museum {descriptor}?
award_conferred_by | Society and Culture | Organization | which_body_conferred_award | Q618779 | award | P571 | P1027 | conferred by | Which organization confers the award {descriptor}?
exhibition_museum | Society and Culture | Organization | which_museum_hosted_exhibition | Q464980 | exhibition | P585 | P276 | location | Which museum hosted the exhibition {descriptor}?
event_venue | Society and Culture | Place | where_event_held | Q1656682 | event | P585 | P276 | location | Where was {descriptor} held?
religious_leader_successor | Philosophy and Religion | Person | who_succeeded_religious_leader | Q246434 | religious office | P580 | P156 | followed by | Who succeeded {descriptor}? | style=fact_join
encyclical_author | Philosophy and Religion | Person | who_wrote_encyclical | Q240157 | encyclical | P577 | P50 | author | Who wrote the encyclical {descriptor}?
religious_text_language | Philosophy and Religion | Language | what_language_religious_text | Q179461 | religious text | P577 | P364 | original language of work | What language was the religious text {descriptor} originally written in?
temple_country | Philosophy and Religion | Place | which_country_temple_located | Q44539 | temple | P571 | P17 | country | In which country is the temple {descriptor} located?
philosophy_book_author | Philosophy and Religion | Person | who_wrote_philosophy_book | Q571 | book | P577 | P50 | author | Who wrote the philosophy book {descriptor}?
poetry_collection_author | Language and Literature | Person | who_wrote_poetry_collection | Q12106333 | poetry collection | P577 | P50 | author | Who wrote the poetry collection {descriptor}?
book_publisher | Language and Literature | Organization | which_publisher_released_book | Q571 | book | P577 | P123 | publisher | Which publisher released the book {descriptor}?
novella_original_language | Language and Literature | Language | what_language_novella_originally_written | Q1238720 | novella | P577 | P364 | original language of work | What language was the novella {descriptor} originally written in?
essay_collection_author | Language and Literature | Person | who_wrote_essay_collection | Q267628 | essay collection | P577 | P50 | author | Who wrote the essay collection {descriptor}?
literary_magazine_country | Language and Literature | Place | which_country_literary_magazine | Q41298 | magazine | P571 | P17 | country | In which country is the magazine {descriptor} based?
film_screenwriter | Arts and Media | Person | who_wrote_film | Q11424 | film | P577 | P58 | screenwriter | Who wrote the film {descriptor}?
film_based_on | Arts and Media | Work | what_work_film_based_on | Q11424 | film | P577 | P144 | based on | What work was the film {descriptor} based on?
tv_series_creator | Arts and Media | Person | who_created_series | Q5398426 | television series | P577 | P170 | creator | Who created the television series {descriptor}?
documentary_narrator | Arts and Media | Person | who_narrated_documentary | Q93204 | documentary film | P577 | P2438 | narrator | Who narrated the documentary {descriptor}?
music_video_director | Arts and Media | Person | who_directed_music_video | Q64100970 | music video | P577 | P57 | director | Who directed the music video {descriptor}?
podcast_host | Arts and Media | Person | who_hosts_podcast | Q24634210 | podcast | P577 | P371 | presenter | Who hosts the podcast {descriptor}?
album_label | Arts and Media | Organization | which_label_released_album | Q482994 | album | P577 | P264 | record label | Which label released the album {descriptor}?
comic_writer | Arts and Media | Person | who_wrote_comic | Q1004 | comic | P577 | P50 | author | Who wrote the comic {descriptor}?
animation_studio | Arts and Media | Organization | which_studio_produced_animation | Q202866 | animated film | P577 | P272 | production company | Which studio produced the animated film {descriptor}?
theater_location | Arts and Media | Place | where_theater_located | Q24354 | theatre | P571 | P17 | country | In which country is the theatre {descriptor} located?
tournament_host_country | Sports and Recreation | Place | which_country_hosted_tournament | Q132241 | tournament | P585 | P17 | country | Which country hosted {descriptor}?
stadium_architect | Sports and Recreation | Person | who_designed_stadium | Q483110 | stadium | P571 | P84 | architect | Who designed the stadium {descriptor}?
sports_venue_city | Sports and Recreation | Place | which_city_sports_venue_located | Q1076486 | sports venue | P571 | P131 | located in administrative territorial entity | Which city includes the sports venue {descriptor}?
club_founder | Sports and Recreation | Person | who_founded_club | Q847017 | sports club | P571 | P112 | founder | Who founded the club {descriptor}?
competition_venue | Sports and Recreation | Place | where_competition_held | Q16510064 | sports competition | P585 | P276 | location | Where was {descriptor} held?
graduate_before_employer | Education | Organization | which_university_before_employer | Q5 | human | P569 | P69 | educated at | From which university did {descriptor} graduate before working at {employer_label}? | style=fact_join
degree_granting_university | Education | Organization | which_university_granted_degree | Q189533 | degree | P577 | P1027 | conferred by | Which university grants the degree {descriptor}?
school_founder | Education | Person | who_founded_school | Q3914 | school | P571 | P112 | founder | Who founded the school {descriptor}?
curriculum_author | Education | Person | who_wrote_curriculum | Q11774891 | curriculum | P577 | P50 | author | Who wrote the curriculum {descriptor}?
textbook_publisher | Education | Organization | which_publisher_released_textbook | Q571 | textbook | P577 | P123 | publisher | Which publisher released the textbook {descriptor}?
math_textbook_author | Mathematics | Person | who_wrote_math_textbook | Q571 | book | P577 | P50 | author | Who wrote the mathematics book {descriptor}?
math_software_developer | Mathematics | Organization | which_company_developed_math_software | Q7397 | software | P577 | P178 | developer | Which company developed the mathematics software {descriptor}?
math_paper_journal | Mathematics | Organization | which_journal_published_math_article | Q13442814 | scholarly article | P577 | P1433 | published in | In which journal was the mathematics article {descriptor} published?
dataset_creator_math | Mathematics | Person | who_created_math_dataset | Q1172284 | dataset | P577 | P170 | creator | Who created the dataset {descriptor}?
chemistry_article_journal | Physical Sciences | Organization | which_journal_published_chemistry_article | Q13442814 | scholarly article | P577 | P1433 | published in | In which journal was the chemistry article {descriptor} published?
physics_book_author | Physical Sciences | Person | who_wrote_physics_book | Q571 | book | P577 | P50 | author | Who wrote the physics book {descriptor}?
instrument_manufacturer | Physical Sciences | Organization | which_company_made_instrument | Q34379 | scientific instrument | P577 | P176 | manufacturer | Which company manufactured the instrument {descriptor}?
space_telescope_operator | Physical Sciences | Organization | which_agency_operates_telescope | Q2133344 | space telescope | P571 | P137 | operator | Which agency operates the telescope {descriptor}?
physical_science_dataset_creator | Physical Sciences | Person | who_created_science_dataset | Q1172284 | dataset | P577 | P170 | creator | Who created the physical science dataset {descriptor}?
genome_project_lead_org | Life Sciences | Organization | which_org_led_genome_project | Q3966 | genome project | P577 | P749 | parent organization | Which organization led the genome project {descriptor}?
species_described_by | Life Sciences | Person | who_described_species | Q16521 | taxon | P577 | P405 | taxon author | Who first described the species {descriptor}?
bioinformatics_software_developer | Life Sciences | Organization | which_company_developed_bioinformatics_software | Q7397 | software | P577 | P178 | developer | Which company developed the bioinformatics software {descriptor}?
biology_article_journal | Life Sciences | Organization | which_journal_published_biology_article | Q13442814 | scholarly article | P577 | P1433 | published in | In which journal was the biology article {descriptor} published?
biobank_country | Life Sciences | Place | which_country_biobank_located | Q4915012 | biobank | P571 | P17 | country | In which country is the biobank {descriptor} located?
medicine_active_ingredient | Medicine and Health | Other | what_active_ingredient_medicine | Q12140 | medication | P577 | P3781 | active ingredient in pharmaceutical product | What is the main active ingredient in the medicine {descriptor}?
vaccine_developer | Medicine and Health | Organization | which_company_developed_vaccine | Q877194 | vaccine | P577 | P178 | developer | Which company developed the vaccine {descriptor}?
hospital_country | Medicine and Health | Place | which_country_hospital_located | Q16917 | hospital | P571 | P17 | country | In which country is the hospital {descriptor} located?
clinical_guideline_author | Medicine and Health | Organization | which_body_wrote_guideline | Q617602 | clinical guideline | P577 | P50 | author | Which organization wrote the guideline {descriptor}?
medical_device_manufacturer | Medicine and Health | Organization | which_company_made_medical_device | Q174784 | medical device | P577 | P176 | manufacturer | Which company manufactured the medical device {descriptor}?
spacecraft_operator | Earth, Environment, and Space | Organization | which_agency_operates_spacecraft | Q40218 | spacecraft | P577 | P137 | operator | Which agency operates the spacecraft {descriptor}?
space_mission_launch_site | Earth, Environment, and Space | Place | where_space_mission_launched | Q2133344 | space mission | P585 | P1427 | start point | From where was {descriptor} launched?
climate_report_author | Earth, Environment, and Space | Organization | which_body_wrote_report | Q10870555 | report | P577 | P50 | author | Which organization wrote the report {descriptor}?
satellite_manufacturer | Earth, Environment, and Space | Organization | which_company_built_satellite | Q2537 | artificial satellite | P577 | P176 | manufacturer | Which company built the satellite {descriptor}?
environmental_project_lead | Earth, Environment, and Space | Person | who_led_environment_project | Q170584 | project | P571 | P1037 | director / manager | Who led the project {descriptor}?
ai_model_developer | Computer Science and AI | Organization | which_company_developed_model | Q7397 | software | P577 | P178 | developer | Which company developed the model {descriptor}?
programming_language_designer | Computer Science and AI | Person | who_designed_programming_language | Q9143 | programming language | P577 | P287 | designed by | Who designed the programming language {descriptor}?
framework_license | Computer Science and AI | Other | what_license_framework | Q271680 | software framework | P577 | P275 | copyright license | What license does the framework {descriptor} use?
dataset_creator_ai | Computer Science and AI | Person | who_created_ai_dataset | Q1172284 | dataset | P577 | P170 | creator | Who created the dataset {descriptor}?
paper_conference_ai | Computer Science and AI | Organization | which_conference_published_ai_paper | Q13442814 | scholarly article | P577 | P1433 | published in | At which venue was the AI paper {descriptor} published?
benchmark_release_date | Computer Science and AI | Date | when_benchmark_released | Q1172284 | dataset | P577 | P577 | publication date | On what day, month, and year was the benchmark {descriptor} released? | format=date; granularity=day; mode=date_answer
device_manufacturer | Engineering and Technology | Organization | which_company_made_device | Q1183543 | device | P577 | P176 | manufacturer | Which company manufactured the device {descriptor}?
robot_creator | Engineering and Technology | Person | who_created_robot | Q11012 | robot | P571 | P170 | creator | Who created the robot {descriptor}?
vehicle_designer | Engineering and Technology | Person | who_designed_vehicle | Q42889 | vehicle | P577 | P287 | designed by | Who designed the vehicle {descriptor}?
chip_architecture_designer | Engineering and Technology | Organization | which_company_designed_chip_architecture | Q11426 | microprocessor | P577 | P287 | designed by | Which company designed the chip {descriptor}?
product_release_date | Engineering and Technology | Date | when_product_released | Q2424752 | product | P577 | P577 | publication date | On what day, month, and year was the product {descriptor} released? | format=date; granularity=day; mode=date_answer
rail_station_country | Architecture and Transportation | Place | which_country_station_located_arch | Q55488 | railway station | P571 | P17 | country | In which country is the railway station {descriptor} located?
bridge_architect | Architecture and Transportation | Person | who_designed_bridge | Q12280 | bridge | P571 | P84 | architect | Who designed the bridge {descriptor}?
port_operator | Architecture and Transportation | Organization | which_company_operates_port | Q44782 | port | P571 | P137 | operator | Which organization operates the port {descriptor}?
train_manufacturer | Architecture and Transportation | Organization | which_company_built_train | Q870 | train | P577 | P176 | manufacturer | Which company built the train {descriptor}?
terminal_opening_date | Architecture and Transportation | Date | when_terminal_opened | Q55488 | terminal | P571 | P571 | inception | On what day, month, and year did the terminal {descriptor} open? | format=date; granularity=day; mode=date_answer
beverage_manufacturer | Food, Agriculture, and Daily Life | Organization | which_company_made_beverage | Q40050 | beverage | P577 | P176 | manufacturer | Which company manufactured the beverage {descriptor}?
crop_variety_developer | Food, Agriculture, and Daily Life | Organization | which_org_developed_crop_variety | Q11004 | crop | P577 | P178 | developer | Which organization developed the crop variety {descriptor}?
kitchen_appliance_manufacturer | Food, Agriculture, and Daily Life | Organization | which_company_made_appliance | Q260521 | kitchen appliance | P577 | P176 | manufacturer | Which company manufactured the kitchen appliance {descriptor}?
restaurant_founder | Food, Agriculture, and Daily Life | Person | who_founded_restaurant | Q11707 | restaurant | P571 | P112 | founder | Who founded the restaurant {descriptor}?
biography_place_of_death_recent_subject | People | Place | where_person_died | Q5 | human | P569 | P20 | place of death | Where did {descriptor} die?
biography_occupation_recent_subject | People | Other | what_occupation_person | Q5 | human | P569 | P106 | occupation | What is the occupation of {descriptor}?
biography_notable_work_recent_subject | People | Work | what_notable_work_person | Q5 | human | P569 | P800 | notable work | What is a notable work by {descriptor}?
new_dam_country | Geography | Place | which_country_dam_located | Q12323 | dam | P571 | P17 | country | In which country is the dam {descriptor} located?
new_nature_reserve_country | Geography | Place | which_country_nature_reserve_located | Q473972 | nature reserve | P571 | P17 | country | In which country is the nature reserve {descriptor} located?
constitution_jurisdiction | Politics and Law | Place | which_jurisdiction_constitution | Q7755 | constitution | P577 | P1001 | applies to jurisdiction | To which jurisdiction does the constitution {descriptor} apply?
government_agency_jurisdiction | Politics and Law | Place | which_jurisdiction_agency | Q327333 | government agency | P571 | P1001 | applies to jurisdiction | To which jurisdiction does the government agency {descriptor} apply?
company_parent_organization | Economy and Business | Organization | which_parent_company | Q783794 | company | P571 | P749 | parent organization | Which organization is the parent of the company {descriptor}?
company_industry | Economy and Business | Other | what_industry_company | Q783794 | company | P571 | P452 | industry | What industry is the company {descriptor} in?
stock_exchange_country | Economy and Business | Place | which_country_exchange_located | Q11654 | stock exchange | P571 | P17 | country | In which country is the stock exchange {descriptor} located?
library_country | Society and Culture | Place | which_country_library_located | Q7075 | library | P571 | P17 | country | In which country is the library {descriptor} located?
heritage_site_country | Society and Culture | Place | which_country_heritage_site_located | Q9259 | heritage site | P571 | P17 | country | In which country is the heritage site {descriptor} located?
church_country | Philosophy and Religion | Place | which_country_church_located | Q16970 | church building | P571 | P17 | country | In which country is the church {descriptor} located?
monastery_country | Philosophy and Religion | Place | which_country_monastery_located | Q44613 | monastery | P571 | P17 | country | In which country is the monastery {descriptor} located?
play_author | Language and Literature | Person | who_wrote_play | Q25379 | play | P577 | P50 | author | Who wrote the play {descriptor}?
poem_author | Language and Literature | Person | who_wrote_poem | Q5185279 | poem | P577 | P50 | author | Who wrote the poem {descriptor}?
newspaper_country | Language and Literature | Place | which_country_newspaper_based | Q11032 | newspaper | P571 | P17 | country | In which country is the newspaper {descriptor} based?
opera_composer | Arts and Media | Person | who_composed_opera | Q1344 | opera | P577 | P86 | composer | Who composed the opera {descriptor}?
film_production_company | Arts and Media | Organization | which_company_produced_film | Q11424 | film | P577 | P272 | production company | Which company produced the film {descriptor}?
manga_author | Arts and Media | Person | who_wrote_manga | Q8274 | manga | P577 | P50 | author | Who wrote the manga {descriptor}?
sports_league_operator | Sports and Recreation | Organization | which_body_operates_league | Q15991303 | sports league | P571 | P137 | operator | Which organization operates the league {descriptor}?
sports_team_home_venue | Sports and Recreation | Place | which_venue_team_plays_home | Q847017 | sports club | P571 | P115 | home venue | At which venue does the team {descriptor} play home matches?
university_country | Education | Place | which_country_university_located | Q3918 | university | P571 | P17 | country | In which country is the university {descriptor} located?
textbook_author | Education | Person | who_wrote_textbook | Q571 | textbook | P577 | P50 | author | Who wrote the textbook {descriptor}?
math_article_main_subject | Mathematics | Other | what_subject_math_article | Q13442814 | scholarly article | P577 | P921 | main subject | What is the main subject of the mathematics article {descriptor}?
math_award_presenter | Mathematics | Organization | which_body_presents_math_award | Q618779 | award | P571 | P1027 | conferred by | Which organization confers the mathematics award {descriptor}?
spacecraft_manufacturer | Physical Sciences | Organization | which_company_built_spacecraft | Q40218 | spacecraft | P577 | P176 | manufacturer | Which company built the spacecraft {descriptor}?
scientific_instrument_operator | Physical Sciences | Organization | which_body_operates_instrument | Q34379 | scientific instrument | P577 | P137 | operator | Which organization operates the scientific instrument {descriptor}?
species_parent_taxon | Life Sciences | Other | what_parent_taxon_species | Q16521 | taxon | P577 | P171 | parent taxon | What is the parent taxon of {descriptor}?
taxonomy_database_creator | Life Sciences | Person | who_created_taxonomy_dataset | Q1172284 | dataset | P577 | P170 | creator | Who created the taxonomy dataset {descriptor}?
medical_school_country | Medicine and Health | Place | which_country_medical_school_located | Q3914 | medical school | P571 | P17 | country | In which country is the medical school {descriptor} located?
clinical_guideline_publisher | Medicine and Health | Organization | which_publisher_guideline | Q617602 | clinical guideline | P577 | P123 | publisher | Which publisher released the guideline {descriptor}?
satellite_operator | Earth, Environment, and Space | Organization | which_agency_operates_satellite | Q2537 | artificial satellite | P577 | P137 | operator | Which agency operates the satellite {descriptor}?
report_publisher | Earth, Environment, and Space | Organization | which_publisher_report | Q10870555 | report | P577 | P123 | publisher | Which publisher released the report {descriptor}?
operating_system_developer | Computer Science and AI | Organization | which_company_developed_operating_system | Q9135 | operating system | P577 | P178 | developer | Which company developed the operating system {descriptor}?
database_system_developer | Computer Science and AI | Organization | which_company_developed_database_system | Q176165 | database management system | P577 | P178 | developer | Which company developed the database system {descriptor}?
software_license | Computer Science and AI | Other | what_license_software | Q7397 | software | P577 | P275 | copyright license | What license does the software {descriptor} use?
aircraft_manufacturer | Engineering and Technology | Organization | which_company_built_aircraft | Q11436 | aircraft | P577 | P176 | manufacturer | Which company built the aircraft {descriptor}?
engine_designer | Engineering and Technology | Person | who_designed_engine | Q44167 | engine | P577 | P287 | designed by | Who designed the engine {descriptor}?
battery_manufacturer | Engineering and Technology | Organization | which_company_made_battery | Q11173 | battery | P577 | P176 | manufacturer | Which company manufactured the battery {descriptor}?
airport_operator | Architecture and Transportation | Organization | which_body_operates_airport | Q1248784 | airport | P571 | P137 | operator | Which organization operates the airport {descriptor}?
lighthouse_country | Architecture and Transportation | Place | which_country_lighthouse_located | Q39715 | lighthouse | P571 | P17 | country | In which country is the lighthouse {descriptor} located?
cookbook_author | Food, Agriculture, and Daily Life | Person | who_wrote_cookbook | Q571 | cookbook | P577 | P50 | author | Who wrote the cookbook {descriptor}?
company_that_released_product_founder | Economy and Business | Person | who_founded_company_that_released_product | Q2424752 | product | P577 | COMPOSED_PRODUCT_MANUFACTURER_FOUNDER | founder of manufacturer | Who founded the company that released the product {descriptor}? | style=fact_join; mode=time_related_join; clues=released; slot=subject; hop=1
company_that_developed_benchmark_founder | Computer Science and AI | Person | who_founded_company_that_developed_benchmark | Q1172284 | benchmark | P577 | COMPOSED_BENCHMARK_DEVELOPER_FOUNDER | founder of developer | Who founded the organization that developed the benchmark {descriptor}? | style=fact_join; mode=time_related_join; clues=developed; slot=subject; hop=1
terminal_operator_country | Architecture and Transportation | Place | which_country_operator_of_terminal | Q55488 | terminal | P571 | COMPOSED_TERMINAL_OPERATOR_COUNTRY | country of operator | In which country is the organization that operates the terminal {descriptor} based? | style=fact_join; mode=time_related_join; clues=operates; slot=subject; hop=1
tv_series_source_work_author | Arts and Media | Person | who_wrote_source_work_for_series | Q5398426 | television series | P577 | COMPOSED_SOURCE_WORK_AUTHOR | author of source work | Who wrote the work that the television series {descriptor} was based on? | style=fact_join; mode=time_related_join; clues=based on; slot=subject; hop=1
footballer_goals_in_ordinal_tournament | Sports and Recreation | Number | how_many_goals_footballer_in_ordinal_tournament | Q937857 | association football player | P585 | COMPOSED_ORDINAL_TOURNAMENT_GOALS | goals scored in ordinal tournament | How many goals did {descriptor} score in the {ordinal} tournament? | format=number; style=ordinal_fact; mode=time_related_join; clues=goals,tournament; slot=relation; hop=2
acquisition_purchase_price | Economy and Business | Number | how_many_dollars_company_spent_to_acquire_target | Q783794 | company | P571 | COMPOSED_ACQUISITION_PRICE | acquisition purchase price | How many dollars did {acquirer_label} spend to acquire {descriptor}? | format=number; style=fact_join; mode=time_related_join; clues=acquire; slot=relation; hop=1
person_birth_date | People | Date | when_person_born | Q5 | human | P569 | P569 | date of birth | On what day, month, and year was {descriptor} born? | format=date; granularity=day; mode=date_answer
person_death_date | People | Date | when_person_died | Q5 | human | P570 | P570 | date of death | On what day, month, and year did {descriptor} die? | format=date; granularity=day; mode=date_answer
film_release_date | Arts and Media | Date | when_film_released | Q11424 | film | P577 | P577 | publication date | On what day, month, and year was the film {descriptor} released? | format=date; granularity=day; mode=date_answer
paper_author_count | Physical Sciences | Number | how_many_authors_paper | Q13442814 | scholarly article | P577 | P50 | author | How many authors wrote the article {descriptor}? | format=number; style=fact_join
math_article_author_count | Mathematics | Number | how_many_authors_math_article | Q13442814 | scholarly article | P577 | P50 | author | How many authors wrote the mathematics article {descriptor}? | format=number; style=fact_join
biology_article_author_count | Life Sciences | Number | how_many_authors_biology_article | Q13442814 | scholarly article | P577 | P50 | author | How many authors wrote the biology article {descriptor}? | format=number; style=fact_join
guideline_author_count | Medicine and Health | Number | how_many_authors_guideline | Q617602 | clinical guideline | P577 | P50 | author | How many authors wrote the guideline {descriptor}? | format=number; style=fact_join
report_author_count | Earth, Environment, and Space | Number | how_many_authors_report | Q10870555 | report | P577 | P50 | author | How many authors wrote the report {descriptor}? | format=number; style=fact_join
album_track_count | Arts and Media | Number | how_many_tracks_album | Q482994 | album | P577 | P658 | tracklist | How many tracks are on the album {descriptor}? | format=number; style=fact_join
story_collection_story_count | Language and Literature | Number | how_many_stories_collection | Q13136 | short story collection | P577 | P527 | has part | How many stories are in the collection {descriptor}? | format=number; style=fact_join
company_founder_count | Economy and Business | Number | how_many_founders_company | Q783794 | company | P571 | P112 | founder | How many founders did the company {descriptor} have? | format=number; style=fact_join
startup_founder_count | Economy and Business | Number | how_many_founders_startup | Q4830453 | business | P571 | P112 | founder | How many founders did the startup {descriptor} have? | format=number; style=fact_join
treaty_signatory_count | Politics and Law | Number | how_many_signatories_treaty | Q131569 | treaty | P577 | P17 | country | How many signatories did the treaty {descriptor} have? | format=number; style=fact_join
festival_day_count | Society and Culture | Number | how_many_days_festival | Q132241 | festival | P585 | P580 | start time | How many days did {descriptor} last? | format=number; style=fact_join
spacecraft_crew_count | Earth, Environment, and Space | Number | how_many_crew_spacecraft | Q40218 | spacecraft | P577 | P1029 | crew member | How many crew members were on {descriptor}? | format=number; style=fact_join
spacecraft_payload_count | Earth, Environment, and Space | Number | how_many_payloads_spacecraft | Q40218 | spacecraft | P577 | P527 | has part | How many payloads did {descriptor} carry? | format=number; style=fact_join
rover_wheel_count | Engineering and Technology | Number | how_many_wheels_rover | Q11012 | robot | P571 | P527 | has part | How many wheels does the rover {descriptor} have? | format=number; style=fact_join
patent_inventor_count | Engineering and Technology | Number | how_many_inventors_patent | Q253623 | patent | P577 | P61 | discoverer or inventor | How many inventors are listed on the patent {descriptor}? | format=number; style=fact_join
bridge_span_count | Architecture and Transportation | Number | how_many_spans_bridge | Q12280 | bridge | P571 | P527 | has part | How many spans does the bridge {descriptor} have? | format=number; style=fact_join
sports_event_host_count | Sports and Recreation | Number | how_many_host_cities_event | Q16510064 | sports competition | P585 | P276 | location | How many host locations were used for {descriptor}? | format=number; style=fact_join
textbook_editor_count | Education | Number | how_many_editors_textbook | Q571 | textbook | P577 | P98 | editor | How many editors worked on the textbook edition {descriptor}? | format=number; style=fact_join
medicine_ingredient_count | Medicine and Health | Number | how_many_active_ingredients_medicine | Q12140 | medication | P577 | P3781 | active ingredient in pharmaceutical product | How many active ingredients are in the medicine {descriptor}? | format=number; style=fact_join
dataset_language_count | Computer Science and AI | Number | how_many_languages_dataset | Q1172284 | dataset | P577 | P407 | language of work or name | How many languages are represented in the dataset {descriptor}? | format=number; style=fact_join
project_partner_count | Engineering and Technology | Number | how_many_partners_project | Q170584 | project | P571 | P749 | parent organization | How many partner organizations were involved in the project {descriptor}? | format=number; style=fact_join
ordinal_country_president | Politics and Law | Person | who_was_ordinal_president | Q6256 | country | P585 | P39 | position held | Who was the {ordinal} president of {descriptor}? | style=ordinal_fact
ordinal_country_prime_minister | Politics and Law | Person | who_was_ordinal_prime_minister | Q6256 | country | P585 | P39 | position held | Who was the {ordinal} prime minister of {descriptor}? | style=ordinal_fact
ordinal_tournament_winner | Sports and Recreation | Person | who_won_ordinal_tournament | Q132241 | tournament | P585 | P1346 | winner | Who won the {ordinal} edition of {descriptor}? | style=ordinal_fact; mode=time_related_join; slot=subject; hop=1
ordinal_tournament_host_city | Sports and Recreation | Place | which_city_hosted_ordinal_tournament | Q132241 | tournament | P585 | P131 | located in administrative territorial entity | Which city hosted the {ordinal} edition of {descriptor}? | style=ordinal_fact
ordinal_religious_leader | Philosophy and Religion | Person | who_was_ordinal_religious_leader | Q246434 | religious office | P580 | P39 | position held | Who was the {ordinal} leader of {descriptor}? | style=ordinal_fact
ordinal_university_chancellor | Education | Person | who_was_ordinal_university_chancellor | Q3918 | university | P585 | P39 | position held | Who was the {ordinal} chancellor of {descriptor}? | style=ordinal_fact
ordinal_company_ceo | Economy and Business | Person | who_was_ordinal_company_ceo | Q783794 | company | P585 | P169 | chief executive officer | Who was the {ordinal} chief executive officer of {descriptor}? | style=ordinal_fact
ordinal_space_mission_commander | Earth, Environment, and Space | Person | who_was_ordinal_space_mission_commander | Q2133344 | space mission | P585 | P1037 | director / manager | Who was the {ordinal} commander associated with {descriptor}? | style=ordinal_fact
ordinal_film_in_series_director | Arts and Media | Person | who_directed_ordinal_film_in_series | Q24856 | film series | P577 | P57 | director | Who directed the {ordinal} film in the series {descriptor}? | style=ordinal_fact
ordinal_volume_author | Language and Literature | Person | who_wrote_ordinal_volume | Q571 | book series | P577 | P50 | author | Who wrote the {ordinal} volume in the series {descriptor}? | style=ordinal_fact
"""

# The recorded runs that gave accepted examples, by domain.
FIRST_RUN, SECOND_RUN = "stage5a_single_fact", "stage5b_pilot"
RETRIEVAL_LIMIT = 100


def _options(text: str) -> dict[str, str]:
    return dict(x.strip().partition("=")[::2] for x in text.split(";") if x.strip())


def rows(text: str = TEMPLATES) -> list[tuple]:
    """The templates in a text of that form, as rows of the templates' schema."""
    out, status = [], "active"
    for line in text.strip().splitlines():
        if line.startswith("["):
            status = line.strip("[]")
            continue
        cells = [x.strip() for x in line.split(" | ")]
        own, given = cells[:10], _options(cells[10]) if len(cells) > 10 else {}
        style = given.get("style", "single_fact")
        runs = {"active": [FIRST_RUN, SECOND_RUN], "blueprint": []}.get(status, [SECOND_RUN])
        recipe = (given["clues"].split(",") if "clues" in given else None, given.get("surface") == "true" if "surface" in given else None, given.get("slot"), int(given["hop"]) if "hop" in given else None)
        out.append((
            len(out), *own, given.get("format", "entity"), given.get("granularity"), style, STYLES.get(style, style), given.get("mode", "atemporal"), recipe,
            status, "proven_in_runs" if runs else "not_yet_proven", runs, "", "exact" in given, RETRIEVAL_LIMIT,
        ))
    return out


def templates(spark: SparkSession, text: str = TEMPLATES) -> DataFrame:
    """All templates, in order (``tpl_ord``); some domains occur twice, and the first of them is found by name."""
    return spark.createDataFrame(rows(text), schemas.TEMPLATES)


def active(all_templates: DataFrame) -> DataFrame:
    return all_templates.where("status = 'active'")


def multi_hop_pilot(all_templates: DataFrame) -> DataFrame:
    return all_templates.where("status = 'multi_hop_pilot'")


def date_answer_pilot(all_templates: DataFrame) -> DataFrame:
    return all_templates.where("status = 'date_answer_pilot'")


def blueprint(all_templates: DataFrame) -> DataFrame:
    return all_templates.where("status = 'blueprint'")


def piloted(all_templates: DataFrame) -> DataFrame:
    """Active, multi-hop and date templates, in that order."""
    return all_templates.where("status <> 'blueprint'")


def unproven(all_templates: DataFrame) -> DataFrame:
    return all_templates.where("evidence_status <> 'proven_in_runs'")


def by_domain(all_templates: DataFrame, domain: str) -> DataFrame:
    """The first template of a domain: one row or none."""
    return all_templates.where(F.col("domain") == domain).groupBy("domain").agg(F.min_by(F.struct(*all_templates.columns), "tpl_ord").alias("t")).select("t.*")


def by_domains(all_templates: DataFrame, domains: list[str]) -> DataFrame:
    """The first templates of the domains, in the order asked for; ``ValueError`` if one isn't known."""
    wanted = all_templates.sparkSession.createDataFrame([(d, i) for i, d in enumerate(domains)], "wanted string, place int")
    first = all_templates.join(wanted, F.col("domain") == F.col("wanted")).groupBy("place").agg(F.min_by(F.struct(*all_templates.columns), "tpl_ord").alias("t"))
    found = {r.domain for r in first.select("t.domain").collect()}
    if missing := [d for d in domains if d not in found]:
        raise ValueError(f"unknown domains: {', '.join(missing)}")
    return first.orderBy("place").select("t.*")


def concatenated(*parts: DataFrame) -> DataFrame:
    """Catalogs one after the other; repeated rows stay, and ``tpl_ord`` numbers all of them."""
    out = None
    for k, part in enumerate(parts):
        part = part.withColumn("__part", F.lit(k))
        out = part if out is None else out.unionByName(part)
    place = F.row_number().over(_whole().orderBy("__part", "tpl_ord")) - 1
    return out.withColumn("tpl_ord", place.cast("int")).drop("__part")


def _whole():
    from pyspark.sql import Window

    return Window.partitionBy()


def with_evidence(all_templates: DataFrame, runs: DataFrame) -> DataFrame:
    """Templates with the evidence of recorded runs, ``(domain, evidence_runs)``; blueprints never have any."""
    known = runs.select("domain", F.col("evidence_runs").alias("__runs"))
    joined = all_templates.drop("evidence_runs", "evidence_status").join(known, "domain", "left")
    counted = F.when(F.col("status") != "blueprint", F.col("__runs"))
    return joined.withColumn("evidence_runs", F.coalesce(counted, F.array().cast("array<string>"))).withColumn(
        "evidence_status", F.when(F.size("evidence_runs") > 0, "proven_in_runs").otherwise("not_yet_proven")
    ).select(*all_templates.columns)
